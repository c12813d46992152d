import math

from ledgerlark.functions.stats import spearman_p, t_two_sided_p


def test_t_tail_known_values():
    # t = 2.0 with 10 dof -> two-sided p ~ 0.07339
    assert abs(t_two_sided_p(2.0, 10) - 0.073388) < 1e-5
    # t = 1.0 with 1 dof (Cauchy) -> p = 0.5
    assert abs(t_two_sided_p(1.0, 1) - 0.5) < 1e-9


def test_spearman_p_golden():
    # rho = 0.359 across 8 stores -> p ~ 0.38
    assert round(spearman_p(0.359, 8), 2) == 0.38
    assert spearman_p(1.0, 5) == 0.0
    assert spearman_p(0.5, 2) is None


def test_erfc_normal_tail():
    z = 2.76
    assert abs(math.erfc(abs(z) / math.sqrt(2)) - 0.0058) < 1e-4
