"""What the file scans of a DataFrame read, after running it."""

from contextlib import contextmanager


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scanned(spark, df, metric, path=""):
    """Sum of a scan metric (``filesSize``: bytes, ``numFiles``, ``numOutputRows``)
    over the scans whose description names ``path``. Adaptive execution is off, so
    that the plan is the one that runs."""
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):
        plan = df.select("*")._jdf.queryExecution()
        plan.toRdd().count()
        leaves = plan.executedPlan().collectLeaves()
        found = [leaves.apply(k) for k in range(leaves.size())]
        return sum(leaf.metrics().get(metric).get().value() for leaf in found
                   if leaf.metrics().contains(metric) and path in leaf.simpleString(1000))
