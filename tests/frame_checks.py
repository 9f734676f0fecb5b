"""What several tests ask of frames."""


def diff_set(result):
    """The diff table as a set of tuples; repeated rows are an error."""
    rows = [tuple(r) for r in result.diff.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def formatted_plan(df) -> str:
    """The physical plan in full, nothing cut off."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
