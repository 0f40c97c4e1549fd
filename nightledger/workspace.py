"""Where a job may put files it writes on the way to its result."""

import uuid


def scratch_path(spark, label, folder=None):
    """A new path below `folder`, by default the shared checkpoint folder of the cluster."""
    root = folder or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
