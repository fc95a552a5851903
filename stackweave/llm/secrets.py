"""Secret scans with corpus-wide ownership: column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stackweave.session import Scratch

# Kinds in report order, their patterns, and the least length of group 2 or of the match.
# Matches of the last two take a whole run of their signs, so there the least length can stand in the pattern.
KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 18),
    ("hex", r"[0-9a-f]{16,}", 16),
)
#: A value that so many owners hold is a widely copied example.
OWNERS = 3
#: A live-looking value has so many different signs, and a digit.
SIGNS = 8
#: A sign that no pattern can match; texts have it replaced by another such sign first.
MARK, OTHER = "\x01", "\x02"


def _matches(text: Column, pattern: str) -> Column:
    """The leftmost non-overlapping matches as array of (gap, found): signs since the match before, and the match.

    Matches are marked in the text, which is then cut at the marks: every second piece is a match.
    """
    pieces = F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK, -1)
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(pieces) / 2).cast("int") - 1),
        lambda k: F.struct(F.char_length(F.get(pieces, 2 * k)).alias("gap"), F.get(pieces, 2 * k + 1).alias("found")))
    return F.when(F.size(pieces) > 1, pairs)


def base_spans(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)`` of ``docs(doc_id, text, source)``: every row with a key, and the base spans by key.

    Spans have ``row, doc_id, owner, kind, rank, start, end, from, value``; places are code points of the whole text.
    """
    clean = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("\x00")).alias("owner"),
        F.translate(F.coalesce(F.col("text"), F.lit("")), MARK, OTHER).alias("text"))
    found = [_matches(F.col("text"), pattern).alias(kind) for kind, pattern, _ in KINDS]
    # The key keeps rows apart that repeat a doc_id; it is fixed once the table is written.
    rows = scratch.write(clean.select("doc_id", "owner", *found).withColumn("row", F.monotonically_increasing_id()))
    kinds = []
    for rank, (kind, pattern, least) in enumerate(KINDS):
        each = rows.where(F.col(kind).isNotNull()).select("row", "doc_id", "owner", F.posexplode(kind).alias("pos", "m"))
        so_far = W.partitionBy("row").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
        end = F.sum(F.col("m.gap") + F.char_length("m.found")).over(so_far)
        value = F.regexp_extract("m.found", pattern, 2) if kind == "assign" else F.col("m.found")
        each = each.withColumn("end", end).withColumn("value", value).where(F.char_length("value") >= least)
        kinds.append(each.select(
            "row", "doc_id", "owner", F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), (F.col("end") - F.char_length("m.found")).alias("start"), "end",
            (F.col("end") - F.char_length("value")).alias("from"), "value"))
    return rows.select("row", "doc_id"), kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def live_looking(value: Column) -> Column:
    """Whether a value looks drawn and not typed: a digit, a letter and several different signs."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= SIGNS)


def ownership(found: DataFrame, least_owners: int = OWNERS) -> DataFrame:
    """Verdict on each value hash of ``found(hash, repo, owner, live)``: distinct repositories and owners.

    ``example`` if at least ``least_owners`` owners hold it, else ``live`` if it looks so, else ``weak``.
    Copies vanish step by step, inside tasks first: (hash, owner, repo), then (hash, owner), then hash; so a
    value held by everyone reaches the last step as one row per owner.
    """
    per_repo = found.groupBy("hash", "owner", "repo").agg(F.max("live").alias("live"))
    per_owner = per_repo.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"), F.max("live").alias("live"))
    totals = per_owner.groupBy("hash").agg(F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners"), F.max("live").alias("live"))
    return totals.withColumn("verdict", F.when(F.col("owners") >= least_owners, "example").when(F.col("live"), "live").otherwise("weak"))


def scan(docs: DataFrame, scratch: Scratch, least_owners: int = OWNERS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, source)`` with its spans: ``doc_id, base, added``.

    ``base`` has (start, rank, end, kind) of each match in code points, by start and kind order; ``added``
    has (from, end, verdict) of each secret value in them: the corpus's verdict on it. A repository is a
    document, an owner its source; null sources are one owner. Values do not leave the first tables: the
    corpus steps shuffle hashes, and only of rows with spans. Repeated rows are returned as often as they
    come; null texts have no spans, an empty table no rows.
    """
    rows, spans = base_spans(docs, scratch)
    spans = scratch.write(spans.withColumn("live", live_looking(F.col("value"))).withColumn("hash", F.sha2("value", 256)).drop("value"))
    verdicts = ownership(spans.select("hash", F.col("doc_id").alias("repo"), "owner", "live"), least_owners)
    judged = spans.join(verdicts.select("hash", "verdict"), "hash")
    # The spans of one row are bounded by its text.
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind"))).alias("base"),
        F.array_sort(F.collect_set(F.struct("from", "end", "verdict"))).alias("added"))
    return rows.join(per_row, "row", "left").drop("row")


def digest(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example`` per row of ``docs``."""
    found = scan(docs, scratch)
    count = lambda column, field, name: F.coalesce(F.size(F.filter(column, lambda s: s[field] == name)), F.lit(0)).cast("long")
    text = lambda spans: F.coalesce(F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","), F.lit(""))
    added = F.transform("added", lambda s: F.struct(s["from"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["end"].alias("end"), s["verdict"].alias("kind")))
    return found.select(
        "doc_id", *[count("base", "kind", kind).alias(f"n_{kind}") for kind, _, _ in KINDS],
        F.sha2(text("base"), 256).alias("base_sha256"), text(F.array_sort(F.concat("base", added))).alias("spans"),
        *[count("added", "verdict", verdict).alias(f"n_{verdict}") for verdict in ("live", "example")])
