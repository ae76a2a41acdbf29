"""Folders in between belong to the caller that made them."""

import threading

from concord.operators.components import connected_components
from concord.session import scratch, written


def test_callers_do_not_delete_each_others_folders(spark):
    begun, made, counts, errors = threading.Barrier(2), threading.Barrier(2), {}, []

    def caller(name, n):
        try:
            with scratch(spark) as folders:
                begun.wait(60)
                first = written(spark.range(n).toDF("a"), name)
                second = written(first, name)
                made.wait(60)
                folders.discard(second)
                connected_components(second.selectExpr("a", "a div 7 as b")).count()
                made.wait(60)
                counts[name] = (second.count(), len(folders.made))
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=caller, args=x) for x in (("one", 10), ("two", 20))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(180)
    assert not errors and counts["one"][0] == 10 and counts["two"][0] == 20


def test_blocks_nest(spark):
    with scratch(spark) as outer:
        with scratch(spark) as inner:
            kept, gone = written(spark.range(3), "kept"), written(spark.range(4), "gone")
            inner.drop(gone)
        assert outer.made == [kept.written_to] and kept.count() == 3
        outer.discard()
        assert outer.made == []
    assert written(spark.range(2), "alone").count() == 2
