"""Plans after running, for tests on small frames."""

from pyspark.sql import DataFrame

from tableworks.plans.inspect import plan_text


def final_plan_text(df: DataFrame) -> str:
    """Plan after running ``df`` once through its own query execution, so the
    adaptive decisions (skew splits, broadcasts, coalescing) are visible."""
    df.collect()
    return plan_text(df)


def shuffled_rows(df: DataFrame) -> int:
    """Rows that ``df`` wrote to its shuffles, from the metrics of its own run."""
    df.collect()

    def walk(node) -> int:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleRecordsWritten").get().value() if name == "ShuffleExchangeExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())
