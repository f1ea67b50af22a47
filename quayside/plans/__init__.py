from quayside.plans.convert import check, convert, profile_source, run_all, run_feed, run_selected

__all__ = ["check", "convert", "profile_source", "run_all", "run_feed", "run_selected"]
