"""The rewriting of roundings in registered SQL."""

from terraloom.registry.base import nudged


def test_only_roundings_to_six_digits_change():
    assert nudged("select round(x, 6)") == "select (round((x) + 1e-09, 6) + 0.0)"
    assert nudged("select round(x, 2), round(y)") == "select round(x, 2), round(y)"
    assert nudged("select max(x)") == "select max(x)"


def test_nested_calls_and_commas_inside():
    assert nudged("round(greatest(a, b), 6)") == "(round((greatest(a, b)) + 1e-09, 6) + 0.0)"
    assert nudged("round(round(a, 6) + 1, 2)") == "round((round((a) + 1e-09, 6) + 0.0) + 1, 2)"
    assert nudged("sum(round(f(a,6),6))") == "sum((round((f(a,6)) + 1e-09, 6) + 0.0))"


def test_names_that_end_in_round_stay():
    assert nudged("select my_round(x, 6)") == "select my_round(x, 6)"
