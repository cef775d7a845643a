"""Connected components of a distributed set of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window, functions as F

from fieldmark.llm.common import broadcasts, cut, tidy

#: Copies of a root among which the nodes below it are dealt.
SALTS = 32

_ROOTED = pa.schema([("node", pa.int64()), ("root", pa.int64())])


def least_of_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links and the least node of the component each is in."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while len(a):
        low = np.minimum(label[a], label[b])
        # Labels are nodes too: the greater label of a link goes below the lesser one.
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(above := label[label], label):
            label = above
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return nodes, nodes[label]


@tidy
def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of the task's links with the least node that it can reach by them; the least ones too."""
    held = [batch for batch in batches if batch.num_rows]
    if held:
        a, b = (np.concatenate([batch.column(k).to_numpy() for batch in held]) for k in (0, 1))
        nodes, roots = least_of_components(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], schema=_ROOTED)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns ``a``, ``b``): root is the component's least node.

    Each task first contracts its own links, wherever they lie, to one row per node: the least node it reaches
    there.  So a node that a third of all others touch is one row per task.  Per node, the least of its
    tasks' roots is then what the node hangs below; where tasks disagree, their roots are linked for the
    next round, and every node moves up to what its root hangs below, which halves long chains.  It is done
    when no two tasks disagree, which is observed while the table is written.  Each round's table is
    written, which ends its lineage.  Nodes without a link have no row.  No links give no rows.
    """
    links = links.where("a <> b").select("a", "b")
    while True:
        rooted = links.mapInArrow(_contracted, "node long, root long")
        least = F.min("root").over(Window.partitionBy("node"))
        seen = Observation()
        rooted = rooted.withColumn("least", least).observe(seen, F.count_if(F.col("root") > F.col("least")).alias("apart"))
        rooted = cut(rooted, "rooted")
        if not seen.get.get("apart", 0):
            return rooted.groupBy("node").agg(F.min("least").alias("root"))
        # A task's root is itself a node of that task, so it has rows of its own.
        tops = rooted.where("node = root").groupBy(F.col("node").alias("n")).agg(F.min("least").alias("above"))
        tops = cut(tops.where("above < n"), "moving")
        below = rooted.where("node > least")
        found = F.col("least") == F.col("n")
        if not broadcasts(tops):
            # The rows below one root may be very many, so they are dealt over several copies of it.
            tops = tops.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
            below = below.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
            found = found & (F.col("salt") == F.col("s"))
        up = below.join(tops, found, "left")
        up = up.select(F.col("node").alias("a"), F.coalesce("above", "least").alias("b"))
        across = rooted.where("root > least").select(F.col("root").alias("a"), F.col("least").alias("b"))
        links = cut(up.unionByName(across), "links")
