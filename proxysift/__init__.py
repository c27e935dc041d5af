"""Find unusual behaviour in web-proxy logs with Spark DataFrames and Spark ML."""

from proxysift.params import AnalysisParams, JobParams
from proxysift.session import build_session, configure

__all__ = ["AnalysisParams", "JobParams", "build_session", "configure"]
