from loadwright.plans.journal import Journal
from loadwright.plans.load import GovernedLoad, LoadReport, run_load
from loadwright.plans.spec import LoadSpec
from loadwright.plans.store import TableStore
from loadwright.plans.target import TargetTable

__all__ = ["Journal", "GovernedLoad", "LoadReport", "run_load", "LoadSpec", "TableStore", "TargetTable"]
