import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marlstone.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[4]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def rows_of(df, *columns):
    """Rows as sorted tuples, in the order of the named columns."""
    names = columns or tuple(df.columns)
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def close(a, b, places=9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 10**-places * max(1.0, abs(a), abs(b))


PARTS = 16


@pytest.fixture
def many_tasks(spark):
    names = {"spark.sql.shuffle.partitions": str(PARTS), "spark.sql.adaptive.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def largest_reads(spark, run):
    """Rows read by the largest shuffle task of the jobs that ``run`` starts, and all rows that it gives back."""
    context = spark.sparkContext
    store = context._jsc.sc().statusStore()
    known = {s.stageId() for s in _list(context, store.stageList(None, False, False, _doubles(context), None))}
    rows = run()
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    largest = 0
    for stage in _list(context, store.stageList(None, False, False, _doubles(context), None)):
        if stage.stageId() not in known:
            for task in _list(context, store.taskList(stage.stageId(), stage.attemptId(), 10_000)):
                told = task.taskMetrics()
                if told.isDefined():
                    largest = max(largest, told.get().shuffleReadMetrics().recordsRead())
    return largest, rows


def _list(context, found):
    return list(context._jvm.scala.jdk.javaapi.CollectionConverters.asJava(found))


def _doubles(context):
    return context._gateway.new_array(context._jvm.double, 0)
