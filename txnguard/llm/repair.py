"""Repair of the structure of conversations: faults of their rows, gaps, and the cheapest edits that give
the role initials the form ``(s?(ua)+)?``.

A row is blank, a duplicate (role and text seen earlier in its conversation), truncated (its text does not
end in ``.``, ``!`` or ``?``), or in order. Edits keep a row, give it another role, delete it or insert an
empty one (``lattice``). Conversations up to SEGMENT rows are one group each. Longer ones are placed by
range, searched in segments from every state to every other, and the segments' passages are put together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm import lattice
from txnguard.llm.ordering import numbered
from txnguard.session import materialise

#: Rows of a conversation that are searched as one group.
SEGMENT = 1024

_PLAN = "cost long, audit string, source array<int>, roles array<string>"
_BLANK = r"[^\x20\x09-\x0D]"
_WHOLE = r"[.!?][\x20\x09-\x0D]*\z"


def _marked(segments: DataFrame) -> DataFrame:
    """Segments (rows, previous) with their counts and the signature. ``previous`` is the row before the
    first, null at the beginning."""
    initial = "left({0}.role, 1)"
    before = "if(i = 0, previous, get(rows, i - 1))"
    marks = f"""transform(transform(rows, (r, i) -> named_struct('r', r, 'p', {before})), x -> named_struct(
        'fault', CASE WHEN x.r.blank THEN 'blank' WHEN x.r.again THEN 'duplicate' WHEN x.r.cut THEN 'truncated' END,
        'letter', if({initial.format("x.r")} IN ('s', 'u', 'a'), {initial.format("x.r")}, 'x'),
        'new_turn', x.r.turn IS NOT NULL AND NOT (x.r.turn <=> x.p.turn),
        'illegal', x.p IS NOT NULL AND concat({initial.format("x.p")}, {initial.format("x.r")}) NOT IN ('su', 'ua', 'au')))"""
    symbol = f"CASE WHEN m.fault IN ('blank', 'duplicate') THEN '{lattice.GONE}' WHEN m.fault = 'truncated' THEN upper(m.letter) ELSE m.letter END"

    def count(condition: str, name: str) -> str:
        return f"CAST(size(filter(marks, m -> coalesce({condition}, false))) AS BIGINT) AS {name}"

    return segments.withColumn("marks", F.expr(marks)).selectExpr(
        "*",
        f"array_join(transform(marks, m -> {symbol}), '') AS signature",
        *[count(f"m.fault = '{x}'", x) for x in ("blank", "duplicate", "truncated")],
        count("m.illegal", "illegal"),
        count("m.new_turn", "turns"),
        "array_min(transform(rows, r -> r.turn)) AS first_turn",
        "array_max(transform(rows, r -> r.turn)) AS last_turn",
    )


_LINES = (
    "transform(source, (s, j) -> concat(coalesce(roles[j], get(rows, s).role), ':', coalesce(get(rows, s).text, '')))"
)
_GAPS = "CAST(coalesce(last_turn - first_turn + 1 - turns, 0) AS BIGINT) AS gaps"
_REPORT = ["conv", _GAPS, "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _planned(signatures: pd.Series) -> pd.DataFrame:
    found = [lattice.repair_plan(s) for s in signatures]
    return pd.DataFrame([(c, a, *lattice.rows_left(a)) for c, a in found], columns=["cost", "audit", "source", "roles"])


def _short(rows: DataFrame) -> DataFrame:
    member = F.sort_array(F.collect_list(F.struct("turn", "role", "text", "blank", "cut")))
    keys = "transform(sorted, r -> struct(r.role, r.text))"
    again = "transform(sorted, (r, i) -> named_struct('turn', r.turn, 'role', r.role, 'text', r.text, 'blank', r.blank, " \
        "'cut', r.cut, 'again', array_position(seen, struct(r.role, r.text)) <= i))"  # fmt: skip
    grouped = rows.groupBy("key", "conv").agg(member.alias("sorted"))
    whole = grouped.selectExpr("conv", "sorted", f"{keys} AS seen").selectExpr("conv", f"{again} AS rows")
    whole = whole.withColumn("previous", F.expr("get(rows, -1)"))  # null, of the rows' type
    planned = _marked(whole).withColumn("plan", F.pandas_udf(_planned, _PLAN)("signature"))
    return planned.selectExpr("*", "plan.*").selectExpr(*_REPORT, f"sha2(array_join({_LINES}, '\n'), 256) AS repaired_sha256")


def _long(rows: DataFrame) -> DataFrame:
    text_key = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    placed = materialise(numbered(rows.withColumn("digest", text_key), "key", ["turn", "role", "text"]))
    firsts = materialise(placed.groupBy("key", "digest").agg(F.min("pos").alias("first")))
    flagged = placed.join(firsts, ["key", "digest"]).withColumn("again", F.col("pos") > F.col("first"))
    # The last row of a segment is also the one before the next segment's first.
    own = F.floor(F.col("pos") / SEGMENT)
    is_last = (F.col("pos") % SEGMENT == SEGMENT - 1) & (F.col("pos") < F.col("n") - 1)
    at = F.when(is_last, F.array(own, own + 1)).otherwise(F.array(own))
    row = F.struct("pos", "turn", "role", "text", "blank", "cut", "again")
    grouped = flagged.withColumn("segment", F.explode(at)).groupBy("key", "conv", "segment")
    segments = grouped.agg(F.sort_array(F.collect_list(row)).alias("rows")).selectExpr(
        "key", "conv", "segment",
        f"filter(rows, r -> r.pos >= segment * {SEGMENT}) AS rows",
        f"if(rows[0].pos < segment * {SEGMENT}, rows[0], NULL) AS previous",
    )
    marked = materialise(_marked(segments).drop("marks", "previous"))

    passage = "array<struct<a: int, b: int, cost: long, audit: string>>"

    @F.pandas_udf(passage)
    def passages(signatures: pd.Series) -> pd.Series:
        return signatures.map(lambda s: [dict(zip(("a", "b", "cost", "audit"), x, strict=True)) for x in lattice.passages(s)])

    part = F.struct("segment", F.length("signature").alias("length"), passages("signature").alias("passages"))
    totals = [F.sum(x).alias(x) for x in ("blank", "duplicate", "truncated", "illegal", "turns")]
    whole = marked.withColumn("part", part).groupBy("key", "conv").agg(
        *totals,
        F.min("first_turn").alias("first_turn"),
        F.max("last_turn").alias("last_turn"),
        F.sort_array(F.collect_list(F.struct("part.segment", "part"))).alias("parts"),
    )

    @F.pandas_udf("cost long, audit string, pieces array<struct<audit: string, before: long, total: long>>")
    def put_together(parts: pd.Series) -> pd.DataFrame:
        out = []
        for ordered in parts:
            steps = [[(x["a"], x["b"], x["cost"], x["audit"]) for x in p["part"]["passages"]] for p in ordered]
            cost, audit = lattice.joined(steps)
            cut = lattice.pieces(audit, [p["part"]["length"] for p in ordered])
            out.append((cost, audit, [dict(zip(("audit", "before", "total"), c, strict=True)) for c in cut]))
        return pd.DataFrame(out, columns=["cost", "audit", "pieces"])

    reports = materialise(whole.withColumn("found", put_together("parts")).drop("parts").selectExpr("*", "found.*").drop("found"))

    @F.pandas_udf("source array<int>, roles array<string>")
    def left(audits: pd.Series, before: pd.Series, total: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([lattice.rows_left(*x) for x in zip(audits, before, total, strict=True)], columns=["source", "roles"])

    cut = reports.select("key", F.posexplode("pieces").alias("segment", "piece"))
    lines = marked.join(cut, ["key", "segment"]).withColumn("left", left("piece.audit", "piece.before", "piece.total"))
    lines = lines.selectExpr("key", "segment", "piece.before", "piece.total", "rows", "left.*")
    joined = lines.selectExpr("key", "segment", "before", "total", "size(source) AS n", f"array_join({_LINES}, '\n') AS text")
    digests = joined.repartition("key").sortWithinPartitions("key", "segment").mapInPandas(_digests, "key string, repaired_sha256 string")
    return reports.join(digests, "key").selectExpr(*_REPORT, "repaired_sha256")


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest per key, of the texts of its rows in turn; a batch at a time is held."""
    key, digest = None, None
    for batch in batches:
        done = []
        for row in batch.itertuples():
            if row.key != key:
                if digest:
                    done.append((key, digest.hexdigest()))
                key, digest = row.key, hashlib.sha256()
            if row.n:
                digest.update((("\n" if row.before else "") + row.text).encode())
        yield pd.DataFrame(done, columns=["key", "repaired_sha256"])
    if digest:
        yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "repaired_sha256"])


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256 (of the repaired rows as ``role:text``, joined by newlines).

    Rows are taken by turn (nulls first; of equal turns by role, then text; repeated rows follow each
    other, and all but the first are duplicates). Null roles and texts count as one space. A null id is a
    conversation of its own. A role without initial among s, u, a has to change or go, an empty one too.
    ``gaps`` are the turns missing between the least and the greatest. Texts are looked at whole. Other
    columns are not looked at. An empty table gives no rows. Audits up to two billion edits can be given.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (text_col, role_col))
    rows = turns.select(
        F.coalesce(F.concat(F.lit("1"), F.col(conv_col).cast("string")), F.lit("0")).alias("key"),
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
    )
    rows = rows.withColumns({"blank": ~F.rlike("text", F.lit(_BLANK)), "cut": ~F.rlike("text", F.lit(_WHOLE))})
    large = materialise(rows.groupBy("key").count().where(F.col("count") > SEGMENT).select("key"))
    if large.isEmpty():
        return _short(rows)
    stored = materialise(rows.join(large, "key", "left_semi"))
    return _short(rows.join(large, "key", "left_anti")).unionByName(_long(stored))
