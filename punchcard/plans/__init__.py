from punchcard.plans.jobs import login_summary_csv, login_summary_table

__all__ = ["login_summary_csv", "login_summary_table"]
