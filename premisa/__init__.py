"""premisa: learning and applying IF-THEN rules on Spark tables."""

from premisa.estimators import (
    ContrastSetRuleClassifier,
    ContrastSetRuleRegressor,
    ContrastSetSurvivalRules,
    ExpertRuleClassifier,
    ExpertRuleRegressor,
    ExpertSurvivalRules,
    RuleClassifier,
    RuleRegressor,
    SurvivalRules,
)
from premisa.operators.covering import Listener
from premisa.sources.arff import arff_scan

__all__ = [
    "ContrastSetRuleClassifier",
    "ContrastSetRuleRegressor",
    "ContrastSetSurvivalRules",
    "ExpertRuleClassifier",
    "ExpertRuleRegressor",
    "ExpertSurvivalRules",
    "Listener",
    "RuleClassifier",
    "RuleRegressor",
    "SurvivalRules",
    "arff_scan",
]
