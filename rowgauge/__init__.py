"""Data-quality scoring for Spark DataFrames."""

from .model import DIMENSIONS, Profile, Rule, RuleSet, compile_rules, load_config
from .plans.assess import Assessment, RuleReport, assess, assess_runs, evaluate, evaluate_slices

__all__ = [
    "DIMENSIONS",
    "Assessment",
    "Profile",
    "Rule",
    "RuleReport",
    "RuleSet",
    "assess",
    "assess_runs",
    "compile_rules",
    "evaluate",
    "evaluate_slices",
    "load_config",
]
