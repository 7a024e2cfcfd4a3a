import pytest

from premisa.plans.params import ContrastParams, InductionParams
from premisa.plans.rules import (
    FIXED, PREFERRED, Rule, add_condition, any_value, at_least, equals, interval, less, not_equals, number_text,
    parse_condition, parse_rule,
)


@pytest.mark.parametrize(
    "text",
    ["a = (-inf, 149)", "a = <122, inf)", "a = (750, inf)", "a = <0.50, 3>", "a = {v w}", "a = !{v}", "a = Any",
     "[[a = <122, inf)]]", "[a = {v}]"],
)
def test_text_round_trip(text):
    assert parse_condition(text).text() == text


def test_other_spellings():
    assert parse_condition("a = <-inf, 750)") == less("a", 750)
    assert parse_condition("a < 149") == less("a", 149)
    assert parse_condition("a >= 3") == at_least("a", 3)
    assert parse_condition("a > 3") == interval("a", 3, None, lo_closed=False)
    assert parse_condition("a @= Any").refine and parse_condition("a @= {1}").value == "1"
    with pytest.raises(ValueError):
        parse_condition("a")


def test_rule_text():
    rule, times = parse_rule("3: IF [[size = (-inf, 4)]] AND colour name = {red} THEN y = {1}")
    assert times == 3 and rule.label == "1" and rule.target == "y"
    assert [c.origin for c in rule.conditions] == [FIXED, "induced"]
    assert parse_rule("inf: IF a = Any THEN")[1] == float("inf")
    assert parse_rule("IF a < 3 THEN y = {NaN}")[0].label is None
    assert parse_rule("IF a < 3 THEN y = {NaN}")[0].conditions == parse_rule("IF a < 3 THEN")[0].conditions


def test_conclusions():
    c = (less("a", 149),)
    assert Rule(c, "class", "regression", value=244.836, std=52.114).text() == "IF a = (-inf, 149) THEN class = {244.84} [192.72,296.95]"
    assert Rule(c, "s", "survival").text() == "IF a = (-inf, 149) THEN "
    assert number_text(149.0) == "149" and number_text(11.855) == "11.86"


def test_intervals_merge():
    both = add_condition((at_least("a", 1),), less("a", 5))
    assert both == (interval("a", 1, 5),)
    assert add_condition(both, at_least("a", 3)) == (interval("a", 3, 5),)
    assert add_condition(both, equals("b", "x")) == (*both, equals("b", "x"))
    # An expert's interval is kept apart from induced ones.
    assert len(add_condition((at_least("a", 1, origin=FIXED),), less("a", 5))) == 2


def test_preferred_text():
    assert parse_condition("[a = {v}]").origin == PREFERRED


def test_params():
    assert InductionParams().min_new(1000) == 50 and InductionParams(minsupp_new=5).min_new(1000) == 5
    assert InductionParams().bins is None and InductionParams(approximate_induction=True).bins == 100
    assert ContrastParams().minsupp_all == (0.8, 0.5, 0.2, 0.1)
    for bad in ({"minsupp_new": -1}, {"max_uncovered_fraction": 2.0}, {"approximate_bins_count": 1}):
        with pytest.raises(ValueError):
            InductionParams(**bad)
    assert InductionParams(induction_measure=lambda p, n, P, N: p).as_dict()["induction_measure"] == "UserDefined"
