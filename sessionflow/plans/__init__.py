from sessionflow.plans.pipeline import BatchStats, process_batch, run_batch
from sessionflow.plans.session import create_spark_session

__all__ = ["BatchStats", "create_spark_session", "process_batch", "run_batch"]
