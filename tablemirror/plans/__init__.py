from tablemirror.plans.rules import MIRROR, UPSERT, Rule, check_rules, load_rules, run_plan

__all__ = ["MIRROR", "UPSERT", "Rule", "check_rules", "load_rules", "run_plan"]
