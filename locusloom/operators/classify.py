"""Calls from features: mixture, filters, evidence rules and overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusloom.functions.loci import final_class, known, ratio

#: Fixed values of the evidence rules.
EXACT_LEAST, CROWDED = 5.0, 5
LOW_PEAK, MID_PEAK, HIGH_PEAK = 12.5, 20.0, 30.0
EXACT_RATIO, STRICT_RATIO = 0.20, 0.40
HIGH_CROWDING, ALTERNATIVES, ALTERNATIVE_GAP, COMPLEX = 7, 2, 4.0, 0.20
MODEL_FEATURES = ("complexity", "strand_bias", "log_clust_len_norm_counts", "ratio_abund_len_phase", "phase_score")


def scaled(features: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``features`` with ``<column>_scaled`` between 0 and 1; a constant column is 0 and a missing value stays null."""
    ends = features.agg(*(f(known(F.col(c))).alias(f"__{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))))
    limit = {n: ends.select(n).scalar() for n in ends.columns}
    span = lambda c: limit[f"__hi_{c}"] - limit[f"__lo_{c}"]
    return features.withColumns({f"{c}_scaled": F.when(span(c) > 0, (known(F.col(c)) - limit[f"__lo_{c}"]) / span(c)).when(known(F.col(c)).isNotNull(), 0.0) for c in columns})


def mixture_labels(features: DataFrame, seed: int = 0) -> DataFrame:
    """``features`` with ``label``: a mixture of two normal components, the one of higher mean phase score being PHAS.

    Rows with a missing model feature, and all rows where fewer than two are whole, are non-PHAS.
    """
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector

    names = [f"{c}_scaled" for c in MODEL_FEATURES]
    ready = scaled(features, MODEL_FEATURES)
    whole = ready.dropna(subset=names).withColumn("__x", array_to_vector(F.array(*names)))
    if len(whole.select("__x").distinct().take(2)) < 2:
        return features.withColumn("label", F.lit("non-PHAS"))
    model = GaussianMixture(k=2, featuresCol="__x", predictionCol="__k", probabilityCol="__p", seed=seed).fit(whole)
    means = model.gaussiansDF.collect()  # two components
    phas = max(range(2), key=lambda k: float(means[k]["mean"][MODEL_FEATURES.index("phase_score")]))
    labelled = model.transform(whole).withColumn("label", F.when(F.col("__k") == phas, "PHAS").otherwise("non-PHAS"))
    rest = ready.where(F.greatest(*(F.col(n).isNull().cast("int") for n in names)) == 1).withColumn("label", F.lit("non-PHAS"))
    return labelled.select(*features.columns, "label").unionByName(rest.select(*features.columns, "label"))


def filtered_label(label: Column, score_cutoff: float, least_peak: float, most_complexity: float) -> Column:
    """PHAS becomes non-PHAS below the cutoffs or above the complexity; comparisons with missing values are never true."""
    weak = (known(F.col("phase_score")) < score_cutoff) | (known(F.col("Peak_Howell_score")) < least_peak)
    return F.when(F.coalesce(weak, F.lit(False)) | F.coalesce(known(F.col("complexity")) > most_complexity, F.lit(False)), "non-PHAS").otherwise(label)


def evidence(label: Column) -> Column:
    """``struct(final_class, evidence_reason)`` of the first rule that holds."""
    value = lambda c: known(F.col(c))
    count = lambda c: F.coalesce(value(c), F.lit(0.0))
    yes = lambda c: F.coalesce(c, F.lit(False))
    exact, peak, strict = value("Howell_exact_support_score"), value("Peak_Howell_score"), value("Peak_Howell_score_strict")
    origin, crowding = F.coalesce(F.trim("Howell_origin_class"), F.lit("")), count("Howell_crowding_window_count")
    weak = yes(ratio(exact, peak) < EXACT_RATIO) | yes(ratio(strict, peak) < STRICT_RATIO)
    context = (
        origin.isin("ambiguous_origin", "mixed_extension_and_ambiguity") | (crowding >= HIGH_CROWDING)
        | (count("Howell_overlapping_alt_count") >= ALTERNATIVES) | yes(peak - value("Howell_overlapping_alt_best_score") <= ALTERNATIVE_GAP)
        | yes(value("complexity") >= COMPLEX)
    )
    call = lambda c, r: F.struct(F.lit(c).alias("final_class"), F.lit(r).alias("evidence_reason"))
    return (
        F.when(label != "PHAS", call("non-PHAS", "classifier_non_phas"))
        .when(exact.isNull() | (exact <= 0) | (origin == "insufficient_exact_support"), call("non-PHAS", "insufficient_exact_support"))
        .when(exact < EXACT_LEAST, call("PHAS-like", "weak_exact_support"))
        .when(yes((peak > LOW_PEAK) & (peak < MID_PEAK)) & (crowding >= CROWDED), call("PHAS-like", "low_score_crowded_window_context"))
        .when(yes((peak >= MID_PEAK) & (peak < HIGH_PEAK)) & weak & context, call("PHAS-like", "weak_scaffold_alternative_context"))
        .otherwise(call("PHAS", "pass"))
    )


def with_overrides(calls: DataFrame, overrides: DataFrame) -> DataFrame:
    """``calls`` with the class of a matching row of ``overrides`` (identifier, alib, final_class) in place of their own.

    The names of the three classes may be spelled in several ways. Two overrides of one key, or any other name (such
    as ``pass`` or ``1``), are an error.
    """
    spelled = F.regexp_replace(F.lower(F.trim("final_class")), "[_ ]", "-")
    named = overrides.select("identifier", "alib", F.when(spelled.isin("phas", "phas-like", "non-phas"), final_class(F.col("final_class"))).alias("__class"))
    once = named.groupBy("identifier", "alib").agg(F.count(F.lit(1)).alias("__n"), F.first("__class").alias("__class"))
    checked = once.select("identifier", "alib", F.when((F.col("__n") == 1) & F.col("__class").isNotNull(), F.col("__class")).otherwise(F.raise_error(F.lit("an override is repeated or names no class"))).alias("__class"))
    out = calls.join(checked, ["identifier", "alib"], "left")
    given = F.col("__class").isNotNull()
    return out.withColumn("evidence_reason", F.when(given, "manual_override").otherwise(F.col("evidence_reason"))).withColumn("final_class", F.coalesce("__class", "final_class")).drop("__class")
