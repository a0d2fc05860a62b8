"""What the scans of executed queries have read, by Spark's own SQL metrics."""

from __future__ import annotations

import re


def scans(spark, action):
    """``[{metric: number}]`` of every file scan that ``action`` runs, with the scan's description as ``what``."""
    return nodes(spark, action, "Scan")


UNITS = {"B": 1, "KiB": 1 << 10, "MiB": 1 << 20, "GiB": 1 << 30}


def nodes(spark, action, kind):
    """``[{metric: number}]`` of every plan node of a kind that ``action`` runs; sizes are in bytes."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store = spark._jsparkSession.sharedState().statusStore()
    # Told by id, not by place: of a long session Spark keeps only the last executions.
    earlier = store.executionsList()
    before = earlier.last().executionId() if earlier.size() else -1
    action()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    found = []
    executions = store.executionsList()
    for i in range(executions.size()):
        run = executions.apply(i).executionId()
        if run <= before:
            continue
        values, graph = store.executionMetrics(run), store.planGraph(run).allNodes()
        for k in range(graph.size()):
            node = graph.apply(k)
            if not node.name().startswith(kind):
                continue
            row = {"what": node.desc()}
            for m in range(node.metrics().size()):
                metric = node.metrics().apply(m)
                told = values.get(metric.accumulatorId())
                # A size of several tasks tells their total first, on a line of its own.
                found_ = re.search(r"(?:^|\n)([\d,.]+)( [KMG]?i?B)?(?: \(|$)", told.get()) if told.isDefined() else None
                if found_:
                    row[metric.name()] = int(float(found_[1].replace(",", "")) * UNITS[(found_[2] or " B").strip()])
            found.append(row)
    return found
