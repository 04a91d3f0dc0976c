"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong parts (assignments, access identifiers, long hexadecimal runs) are reported wherever
they stand.  Weak parts are only shapes: something called a user or client id, a run that
mixes cases and digits, an address.  They count when the parts that complete them stand in
reach:

* a weak secret needs an identifier,
* a weak identifier needs a secret,
* an endpoint needs both.

In reach means in the same document and the same paragraph (no blank line between) and at
most ``reach`` code points apart.  The search is an interval join on bins of ``reach``
code points, semi-joined, so parts never pair up into all combinations.

Positions come from the text between matches: it is split at the pattern, and lengths of
gaps and matches are added up in order, by a window per document and pattern, so thousands
of matches in one text cost no more than their number.

Defined results: NULL and empty texts have no parts.  Every row is judged for itself, also
if its id is NULL or repeated.  Weak parts that overlap a strong one are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


@dataclass(frozen=True)
class Part:
    """A pattern, the role of what it finds, and how many characters its group must have.

    ``hints`` are literals, one of which every match contains in lower case; texts without
    any skip the pattern.
    """

    kind: str
    role: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()


# A greedy run below the least length holds no match, so the least length can stand in the pattern.
STRONG = (
    Part(
        "assign", "secret",
        r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1, 6, ("passw", "secret", "token", "api"),
    ),
    Part("access", "id", r"AKIA[A-Z0-9]{16,}", hints=("akia",)),
    Part("hex", "secret", r"[0-9a-f]{24,}"),
)
WEAK = (
    Part(
        "weak_id", "id",
        r"""\b(?i:access[_-]?(?:key[_-]?)?id|client[_-]?id|user(?:[_-]?name)?|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""",
        1, 3, ("id", "user", "login", "account"),
    ),
    Part(
        "weak_secret", "secret",
        r"(?<![A-Za-z0-9+/_-])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}",
    ),
    Part(
        "endpoint", "endpoint", r"""\b[a-z][a-z0-9+.-]{1,20}://[^\s"'<>|]+""", hints=("://",),
    ),
)
NEEDS = {"weak_secret": ("id",), "weak_id": ("secret",), "endpoint": ("id", "secret")}
BREAK = Part("break", "break", r"\n[\x20\t\r]*\n", hints=("\n",))
_FOUND = "array<struct<kind:string,i:int,gap:int,length:int,held:boolean>>"


def _found(text: Column, part: Part) -> Column:
    """An array with one entry per match: the gap before it, its length, and whether its group is long enough."""
    pattern = F.lit(part.pattern)
    whole, gaps = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, part.pattern, -1)
    value = F.regexp_extract_all(text, pattern, F.lit(part.group)) if part.group else whole
    entry = F.transform(
        F.arrays_zip(whole.alias("m"), F.slice(gaps, F.lit(1), F.size(whole)).alias("g"), value.alias("v")),
        lambda x, i: F.struct(
            F.lit(part.kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("length"),
            (F.length(x["v"]) >= part.least).alias("held"),
        ),
    )
    may = text.rlike(part.pattern)
    for n, hint in enumerate(part.hints):
        has = F.contains(F.lower(text), F.lit(hint))
        hinted = has if n == 0 else hinted | has
    if part.hints:
        may = hinted & may
    return F.when(may, entry).otherwise(F.array().cast(_FOUND)).cast(_FOUND)


def find_parts(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, doc_id, found) per document, written once; ``row`` tells documents apart."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("doc_id"), text.alias("text"))
    arrays = {p.kind: _found(F.col("text"), p) for p in (*STRONG, *WEAK)}
    rows = rows.select("row", "doc_id", "text", *(a.alias(k) for k, a in arrays.items()))
    weak = F.concat(*(F.col(p.kind) for p in WEAK))
    breaks = F.when(F.size(weak) > 0, _found(F.col("text"), BREAK)).otherwise(F.array().cast(_FOUND))
    return materialise(rows.select("row", "doc_id", F.concat(*(F.col(p.kind) for p in STRONG), weak, breaks).alias("found")))


def locate(found: DataFrame) -> DataFrame:
    """(row, kind, start, end, scope) of every part that holds; code points, end exclusive."""
    each = found.where(F.size("found") > 0).select("row", F.inline("found"))
    in_order = Window.partitionBy("row", "kind").orderBy("i")
    until = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("gap").over(until) + F.sum("length").over(until)
    placed = each.select("row", "kind", (end - F.col("length")).alias("start"), end.alias("end"), "held").where("held")
    by_place = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scope = F.count(F.when(F.col("kind") == BREAK.kind, 1)).over(by_place)
    return placed.select("row", "kind", "start", "end", scope.alias("scope")).where(F.col("kind") != BREAK.kind)


def _bins(start: Column, end: Column, reach: int) -> Column:
    return F.explode(F.sequence(F.floor(start / reach), F.floor(end / reach)))


def link(parts: DataFrame, *, reach: int = 200) -> DataFrame:
    """The weak parts whose complements are in reach: (row, kind, start, end)."""
    roles = F.create_map(*(F.lit(x) for p in (*STRONG, *WEAK) for x in (p.kind, p.role)))
    strong = F.col("kind").isin([p.kind for p in STRONG])
    overlapped = parts.where(strong).select(
        "row", F.col("start").alias("a"), F.col("end").alias("b"), _bins(F.col("start"), F.col("end") - 1, reach).alias("bin")
    )
    weak = parts.where(~strong).withColumn("bin", _bins(F.col("start"), F.col("end") - 1, reach))
    hidden = weak.join(
        overlapped,
        (weak["row"] == overlapped["row"]) & (weak["bin"] == overlapped["bin"]) & (weak["start"] < overlapped["b"]) & (overlapped["a"] < weak["end"]),
        "left_semi",
    ).select("row", "kind", "start").distinct()
    free = parts.where(~strong).join(hidden, ["row", "kind", "start"], "left_anti").select("row", "kind", "start", "end", "scope")
    offered = parts.where(strong).select("row", "kind", "start", "end", "scope").union(free).select(
        "row", "scope", roles[F.col("kind")].alias("role"), F.col("start").alias("a"), F.col("end").alias("b"),
        _bins(F.col("start") - reach, F.col("end") + reach, reach).alias("bin"),
    )
    needs = F.create_map(*(x for k, v in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    asked = free.withColumn("role", F.explode(needs[F.col("kind")])).withColumn("bin", _bins(F.col("start"), F.col("end"), reach))
    met = asked.join(
        offered,
        (asked["row"] == offered["row"]) & (asked["scope"] == offered["scope"]) & (asked["role"] == offered["role"])
        & (asked["bin"] == offered["bin"]) & (offered["a"] - asked["end"] <= reach) & (asked["start"] - offered["b"] <= reach),
        "left_semi",
    )
    counts = met.groupBy("row", "kind", "start", "end").agg(F.count_distinct("role").alias("met"))
    wanted = F.create_map(*(F.lit(x) for k, v in NEEDS.items() for x in (k, len(v))))
    return counts.where(F.col("met") == wanted[F.col("kind")]).select("row", "kind", "start", "end")


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", reach: int = 200) -> DataFrame:
    """(row, doc_id, spans) per document; spans: array of (start, rank, end, kind), by start, then kind as listed."""
    found = find_parts(docs, id_column=id_column, text_column=text_column)
    parts = materialise(locate(found))
    strong = parts.where(F.col("kind").isin([p.kind for p in STRONG])).select("row", "kind", "start", "end")
    rank = F.create_map(*(F.lit(x) for n, p in enumerate((*STRONG, *WEAK)) for x in (p.kind, n)))
    spans = strong.union(link(parts, reach=reach)).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", rank[F.col("kind")].alias("rank"), "end", "kind"))).alias("spans")
    )
    return found.select("row", "doc_id").join(spans, "row", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>"))
    )


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def listed(strong_only: bool = False) -> Column:
    """kind:start:end of the spans, joined by commas."""
    spans = F.filter("spans", lambda s: s["rank"] < len(STRONG)) if strong_only else F.col("spans")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
