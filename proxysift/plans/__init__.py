"""The two jobs: log ingest and topic-anomaly analysis."""

from proxysift.plans.anomaly import Trained, detect_anomalies, run_analysis, train
from proxysift.plans.ingest_job import JOBS, JobResult, run_job

__all__ = ["JOBS", "JobResult", "Trained", "detect_anomalies", "run_analysis", "run_job", "train"]
