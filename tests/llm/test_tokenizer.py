import base64
import random
from pathlib import Path

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locusloom.llm.tokenizer import ByteBpe, encode_texts, split_texts, token_count, vocabulary

PATH = vocabulary()
pytestmark = pytest.mark.skipif(not Path(PATH).exists(), reason="no vocabulary here")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
HARD = ["'s's'll're x's  y\n\n z", "\n\na \n b", " 's", "!'s", "a'sb'lll 'tis", "1's2", "  ", "\t", "x \t", "a b  　c", "日本" * 300, "a" * 5000, " " * 900 + "x", "it's 'd", "é'll", "'", "''s", "a' s", "'S'T", "<|endoftext|>", "\0", "🙂‍🔬 x", "ﬁ½Ⅻ²"]


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(PATH)


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("aé1 \n\t'strevmld!.日 ")), max_size=40), max_size=5))
def test_slices_equal_the_pattern(texts):
    assert split_texts(texts) == [regex.findall(PATTERN, t) for t in texts]


def test_ids_equal_the_public_library(bpe, reference):
    rng = random.Random(6)
    letters = "etaoin shrdlu'\n1234 ,.!äßжк中文हि🙂"
    texts = HARD + ["".join(rng.choice(letters) for _ in range(rng.randrange(400))) for _ in range(300)]
    got = list(bpe.encode(texts, at_once=1000))
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert [bpe.decode(ids) for ids in got] == texts


def test_on_spark(spark, bpe):
    rows = [(1, "Hello 世界", "x"), (2, None, "x"), (3, "", "x"), (1, "Hello 世界", "x"), (4, "word " * 20_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_texts(df, ["doc_id"], "text", PATH).collect()
    assert len(got) == 5
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].ids == [] and by_id[3].ids == [] and by_id[2].offsets == []
    one = by_id[1]
    raw = "Hello 世界".encode()
    pieces = [raw[a:b] for a, b in zip(one.offsets, [*one.offsets[1:], len(raw)])]
    assert pieces == [bpe.tokens[i] for i in one.ids] and bpe.decode(one.ids) == "Hello 世界"
    counts = {r.doc_id: r.n for r in df.select("doc_id", token_count(F.col("text"), PATH).alias("n")).collect()}
    assert counts == {1: len(one.ids), 2: None, 3: 0, 4: len(by_id[4].ids)}
    assert encode_texts(df.limit(0), ["doc_id"], "text", PATH).count() == 0
