import itertools
import math
from statistics import NormalDist

from locusloom.functions.stats import _hypergeometric_tails, combined_tails, log_gamma_tail, rank_sum_tails


def rank_sum_tail(*args):
    return float(rank_sum_tails(*([x] for x in args))[0])


def combined_z(a, b):
    p = float(combined_tails([a], [b])[0])
    return None if p != p else p


def test_hypergeometric_tail_is_the_sum():
    tails = _hypergeometric_tails(30, 8)
    for n, x in itertools.product((0, 1, 7, 30), range(9)):
        mass = sum(math.comb(8, k) * math.comb(22, n - k) for k in range(x, min(n, 8) + 1) if n - k <= 22) / math.comb(30, n)
        assert abs(tails[n, x] - mass) < 1e-9


def test_rank_sum_exact_and_normal():
    # every order of 3 and 4 values
    orders = list(itertools.combinations(range(7), 3))
    u = [sum(sum(b < a for b in set(range(7)) - set(o)) for a in o) for o in orders]
    for value in range(13):
        assert abs(rank_sum_tail(value, 3, 4, 0) - sum(x >= value for x in u) / len(u)) < 1e-12
    z = (250 - 200 - 0.5) / math.sqrt(20 * 20 / 12 * 41)
    assert abs(rank_sum_tail(250, 20, 20, 0) - (1 - NormalDist().cdf(z))) < 1e-12
    assert rank_sum_tail(2, 2, 2, 60) == 1.0  # all equal
    tails = rank_sum_tails([3, 3, 40, float("nan")], [3, 3, 2, 3], [4, 4, 5000, 4], [0, 6, 0, 0])  # the exact way has no size limit
    assert abs(tails[0] - sum(x >= 3 for x in u) / len(u)) < 1e-12 and tails[1] != tails[0] and abs(tails[2] - (1 - 441 / math.comb(5002, 2))) < 2e-5 and tails[3] != tails[3]


def test_combined_p_values():
    assert combined_z(0.5, 0.5) == 0.5
    assert combined_z(0.0, 0.3) == 0.0 and combined_z(1.0, 0.3) == 1.0
    assert combined_z(0.0, 1.0) is None
    n = NormalDist()
    assert abs(combined_z(0.01, 0.2) - (1 - n.cdf((n.inv_cdf(0.99) + n.inv_cdf(0.8)) / math.sqrt(2)))) < 1e-12


def test_gamma_tail_for_even_degrees():
    for k, x in ((1, 0.5), (3, 10.0), (40, 30.0), (200, 600.0)):
        terms = [i * math.log(x) - math.lgamma(i + 1) for i in range(k)]
        top = max(terms)
        want = -x + top + math.log(sum(math.exp(t - top) for t in terms))
        assert abs(log_gamma_tail(k, x) - want) < 1e-9 * max(1, abs(want))
