"""What leaves the engine: JSON by status, byte-bounded parts, plain lists, shards."""

from __future__ import annotations

import bisect
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions.text import PLAIN_TRANSPORTS, endpoint_order, filtered_order
from .dedup import keep_first
from .ranks import same


def failed_only(results: DataFrame) -> DataFrame:
    """Rejected rows keep their failed probes only; if all failed the list goes and all_probes_failed is set."""
    all_failed = (F.col("status") == "rejected") & (F.size("probes") > 0) & F.forall("probes", lambda p: ~p["ok"])
    failed = F.when(F.col("status") == "rejected", F.filter("probes", lambda p: ~p["ok"])).otherwise(F.col("probes"))
    return results.withColumns({"all_probes_failed": F.when(all_failed, True), "probes": F.when(~all_failed, failed)})


def with_median_latency(results: DataFrame) -> DataFrame:
    """Adds median_latency_ms, of the probes that succeeded with a latency; null without any."""
    good = F.array_sort(F.transform(F.filter("probes", lambda p: p["ok"] & p["latency_ms"].isNotNull()), lambda p: p["latency_ms"]))
    n, at = F.size("_good"), lambda k: F.get("_good", k.cast("int"))
    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    return results.withColumn("_good", good).withColumn("median_latency_ms", F.when(n > 0, middle)).drop("_good")


def json_lines(df: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """One compact JSON text per row, in order."""
    return (df.orderBy(*order) if order else df).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def write_results(df: DataFrame, path: str, statuses: tuple[str, ...] = ("accepted",), pruned: bool = False, max_bytes: int | None = None) -> None:
    """JSON lines by status, sorted by endpoint; with max_bytes also cut into parts of bounded size."""
    rows = (failed_only(df) if pruned else df).where(F.col("status").isin(*statuses))
    out = rows.withColumn("value", F.to_json(F.struct(*rows.columns)))
    if max_bytes is None:
        out.orderBy(*endpoint_order()).select("status", "value").write.partitionBy("status").text(path)
        return
    sized = out.select("status", "value", F.octet_length("value").alias("size"), *[c.alias(f"_by_{k}") for k, c in enumerate(endpoint_order())])
    order = [F.col(f"_by_{k}") for k in range(len(endpoint_order()))] + [F.col("value")]
    parts = pack_by_bytes(sized, ["status"], order, max_bytes)
    parts.repartition("status", "part").sortWithinPartitions("status", "part", *order).select("status", "part", "value").write.partitionBy("status", "part").text(path)


def filtered_records(df: DataFrame) -> DataFrame:
    """Filtered rows as records: what is known of the candidate in one field, beside reason, detail and stage."""
    own = [f"{c}" for c in df.columns if c in schemas.CANDIDATE_FIELDS]
    return df.select(F.struct(*own).alias("candidate"), "reason", "detail", "stage")


def write_filtered(df: DataFrame, path: str) -> None:
    """JSON lines of filtered records, sorted by stage, reason and endpoint."""
    absent = {c: F.lit(None).cast(kind) for c, kind in (("endpoint_url", "string"), ("host", "string"), ("port", "int"), ("path", "string")) if c not in df.columns}
    json_lines(filtered_records(df.withColumns(absent).orderBy(*filtered_order()))).write.text(path)


def write_corpus(probes: DataFrame, report: DataFrame, path: str, header: dict) -> None:
    """The corpus as one JSON document, and its counts as another, below `path`.

    header: schema_version, corpus_version, generated_at, generator_version, sources_used. probes (position, ...) are
    written line by line in order, so the document is never held in memory. report (kind, rejection_reason, n) is small.
    """
    from ..plans.lineage import checkpointed

    spark, probes = probes.sparkSession, checkpointed(probes)
    counts = {r["kind"]: r["n"] for r in probes.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    head = json.dumps({**header, "probe_counts": counts})[:-1] + ', "probes": ['
    shown = [c for c in schemas.CORPUS_PROBE_FIELDS if c in probes.columns]
    last = probes.agg(F.max("position")).first()[0]
    text = F.concat(F.to_json(F.struct(*shown)), F.when(F.col("position") == last, "").otherwise(","))
    ends = spark.createDataFrame([(0, None, head), (2, None, "]}")], "part int, position long, value string")
    lines = ends.unionByName(probes.select(F.lit(1).alias("part"), F.col("position").cast("long").alias("position"), text.alias("value")))
    lines.repartition(1).sortWithinPartitions("part", "position").select("value").write.text(f"{path}/probe-corpus")
    known = [r.asDict() for r in report.collect()]
    accepted = {r["kind"]: r["n"] for r in known if r["rejection_reason"] is None}
    total, rejected, reasons = Counter(), Counter(), Counter()
    for r in known:
        total[r["kind"]] += r["n"]
        if r["rejection_reason"] is not None:
            rejected[r["kind"]] += r["n"]
            reasons[r["rejection_reason"]] += r["n"]
    facts = {**header, "candidate_counts": total, "accepted_counts": accepted, "rejected_counts": rejected, "rejected_by_reason": reasons}
    spark.createDataFrame([(json.dumps(facts),)], "value string").write.text(f"{path}/metadata")


def in_slices(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """df sorted over all keys, with the `_slice` and `_at` (place in it) of each row; a key's slices are in order.

    A slice is a partition of a range shuffle. Cuts come from a sample, so the result is written once.
    """
    from ..plans.lineage import checkpointed

    n = max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [*map(F.col, keys), *order]
    ranged = df.repartitionByRange(n, *by).sortWithinPartitions(*by)
    return checkpointed(ranged.withColumns({"_slice": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}))


class SliceMap:
    """What a slice of rows does to the open part, for every fill that it may find there.

    Rows join the open part while it has room; the first that doesn't fit begins a part, and from there on all is
    settled. So the map is a list of pieces, one for each row that may be the first not to fit: at most the rows of
    one part, fewer since pieces that end alike are one.
    """

    def __init__(self, sizes: np.ndarray, limit: int):
        #: a part of rows i to j - 1 has their sizes, a comma between and two brackets
        self.sums, self.room = np.concatenate([[0], np.cumsum(sizes.astype(np.int64) + 1)]), limit - 1
        n = len(sizes)
        fitting = np.searchsorted(self.sums, self.sums[:-1] + self.room, side="right") - 1
        self.next = np.maximum(fitting, np.arange(1, n + 1)).tolist()

    def settled(self) -> tuple[list[int], list[int]]:
        """(fill at the end, parts begun) if a part begins with row i."""
        n = len(self.next)
        fill, parts = [0] * n, [0] * n
        for i in range(n - 1, -1, -1):
            j = self.next[i]
            fill[i], parts[i] = (int(self.sums[n] - self.sums[i]), 1) if j >= n else (fill[j], parts[j] + 1)
        return fill, parts

    def pieces(self) -> tuple[list[int], list[int], list[int], int]:
        """(most fill, fill at the end, parts begun) of the pieces, by falling fill, and the bytes of all rows."""
        fill, parts = self.settled()
        reach = int(np.searchsorted(self.sums, self.room, side="right"))
        most: list[int] = []
        ends: list[tuple[int, int]] = []
        for j in range(min(reach, len(fill))):
            # row j is the first not to fit if the fill is above what row j leaves, and at most what row j - 1 leaves
            bound = int(self.room - self.sums[j])
            if ends and ends[-1] == (fill[j], parts[j]):
                continue
            most.append(bound)
            ends.append((fill[j], parts[j]))
        return most, [e[0] for e in ends], [e[1] for e in ends], int(self.sums[-1])

    def parts_of_rows(self, fill: int, part: int) -> list[int]:
        """The part of each row, if the part before has this number and fill; a fill of 0 is no open part."""
        n = len(self.next)
        at = max(0, int(np.searchsorted(self.sums, self.room - fill, side="right")) - 1) if fill else 0
        at = min(at, n)
        out = [part] * at
        while at < n:
            part += 1
            out += [part] * (min(self.next[at], n) - at)
            at = self.next[at]
        return out


def passed(most: list[int], fills: list[int], parts: list[int], whole: int, room: int, fill: int, part: int) -> tuple[int, int]:
    """(fill, part) after a slice, from what was before it."""
    if not fill:
        return fills[0], part + parts[0]
    if fill + whole <= room:
        return fill + whole, part
    # the last piece whose most fill isn't below this one; above all of them the first row doesn't fit
    k = max(0, bisect.bisect_right(most, -fill, key=lambda b: -b) - 1)
    return fills[k], part + parts[k]


def pack_by_bytes(df: DataFrame, keys: list[str], order: list[Column], limit: int, size: str = "size") -> DataFrame:
    """df with `part`, from 1 within each key: consecutive rows whose JSON array stays within `limit` bytes; a longer record is alone.

    The rule runs from row to row, but not through one task: every slice of the order gives its map from the fill of
    the open part to the fill and the parts behind it, the maps of a key are passed through in order - a short row
    for each slice -, and then every slice numbers its own rows.
    """
    names = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    rows = in_slices(df, keys, order)

    def maps(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        most, fills, parts, whole = SliceMap(found.sort_values("_at")["_size"].to_numpy(), limit).pieces()
        return pd.DataFrame([[*key, most, fills, parts, whole]], columns=[*keys, "_slice", "most", "fills", "parts", "whole"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, fill, part = None, 0, 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (key := tuple(r[k] for k in keys)) != of:
                    of, fill, part = key, 0, 0
                out.append({**{k: r[k] for k in keys}, "_slice": r["_slice"], "_fill": fill, "_part": part})
                fill, part = passed(r["most"], r["fills"], r["parts"], r["whole"], limit - 1, fill, part)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([*[batch.schema.field(k) for k in keys], ("_slice", pa.int32()), ("_fill", pa.int64()), ("_part", pa.int64())]))

    def number(_: tuple, found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("_at")
        parts = SliceMap(found["_size"].to_numpy(), limit).parts_of_rows(int(found["_fill"].iloc[0]), int(found["_part"].iloc[0]))
        return pd.DataFrame({"_row": found["_at"], "part": np.array(parts, np.int64)})

    sized = rows.select(*keys, "_slice", "_at", F.col(size).cast("long").alias("_size"))
    found = sized.groupBy(*keys, "_slice").applyInPandas(maps, f"{names}, _slice int, most array<long>, fills array<long>, parts array<long>, whole long")
    entered = found.repartition(*keys).sortWithinPartitions(*keys, "_slice").mapInArrow(entries, f"{names}, _slice int, _fill long, _part long")
    of = entered.select(*[F.col(c).alias(f"_of_{k}") for k, c in enumerate([*keys, "_slice"])], "_fill", "_part")
    met = sized.join(of, same([F.col(c) for c in [*keys, "_slice"]], [F.col(f"_of_{k}") for k in range(len(keys) + 1)]))
    numbered = met.groupBy(*keys, "_slice").applyInPandas(number, "_row long, part long")
    return rows.join(numbered, F.col("_at") == F.col("_row")).drop("_slice", "_at", "_row")


def plain_list(results: DataFrame, include_doh: bool = False) -> DataFrame:
    """(line): host:port of accepted plain endpoints, or the URLs of accepted URL endpoints, each once in order."""
    accepted = results.where("status = 'accepted'")
    line = F.col("endpoint_url") if include_doh else F.concat_ws(":", "host", F.col("port").cast("string"))
    kind = (F.col("transport") == "doh") if include_doh else F.col("transport").isin(*PLAIN_TRANSPORTS)
    kept, _ = keep_first(accepted.where(kind).withColumn("line", line), ["line"], ["ordinal"])
    return kept.orderBy("ordinal").select("line")


def forwarder_lines(results: DataFrame, zone: str = ".") -> DataFrame:
    """(line): `host` or `host@port` of accepted plain endpoints, the first of each host."""
    plain = results.where((F.col("status") == "accepted") & F.col("transport").isin(*PLAIN_TRANSPORTS))
    kept, _ = keep_first(plain, ["host"], ["ordinal"])
    target = F.when(F.col("port") != 53, F.concat_ws("@", "host", F.col("port").cast("string"))).otherwise(F.col("host"))
    return kept.orderBy("ordinal").select(F.concat(F.lit("    forward-addr: "), target).alias("line"))


def backend_lines(results: DataFrame) -> DataFrame:
    """(line): one text block for each endpoint that isn't rejected."""
    rows = results.where("status <> 'rejected'")
    host = F.when(F.col("host").contains(":"), F.concat(F.lit("["), "host", F.lit("]"))).otherwise(F.col("host"))
    plain = F.concat(F.lit('newServer({address="'), host, F.lit(":"), F.col("port").cast("string"), F.lit('"})'))
    doh = F.concat(
        F.lit('newServer({\n  address="'), host, F.lit(":"), F.col("port").cast("string"), F.lit('",\n  tls="openssl",\n  subjectName="'),
        F.coalesce(F.col("tls_server_name"), F.col("host")), F.lit('",\n  dohPath="'), F.coalesce(F.col("path"), F.lit("/dns-query")), F.lit('"\n})'),
    )
    return rows.orderBy("ordinal").select(F.when(F.col("transport") == "doh", doh).otherwise(plain).alias("line"))


def assign_shards(df: DataFrame, n: int, order: list) -> DataFrame:
    """df with `shard` 0..n-1 in order; the first shards get one row more. Ranks come from sorted partitions and their sizes."""
    parts = max(1, df.sparkSession.sparkContext.defaultParallelism)
    from ..plans.lineage import checkpointed

    ranged = checkpointed(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("_c"), F.min("_i").alias("_m"))
    every = Window.orderBy("_p")
    sizes = sizes.withColumns({"_base": F.coalesce(F.sum("_c").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_total": F.sum("_c").over(Window.partitionBy())})
    ranked = ranged.join(F.broadcast(sizes), "_p").withColumn("_r", F.col("_base") + F.col("_i") - F.col("_m"))
    small, extra = F.floor(F.col("_total") / n), F.col("_total") % n
    big = extra * (small + 1)
    shard = F.when(F.col("_r") < big, F.floor(F.col("_r") / (small + 1))).otherwise(extra + F.floor((F.col("_r") - big) / F.greatest(small, F.lit(1))))
    return ranked.withColumn("shard", shard.cast("int")).drop("_p", "_i", "_c", "_m", "_base", "_total", "_r")


def write_shards(df: DataFrame, path: str) -> DataFrame:
    """Writes shard=k folders of JSON; returns the manifest (shard, n)."""
    df.write.partitionBy("shard").json(path)
    return df.groupBy("shard").agg(F.count("*").alias("n")).orderBy("shard")
