"""Secret scan with corpus-wide ownership frequency, in built-in functions only.

Patterns find candidates of the kinds ``assign``, ``access`` and ``hex`` and, as ``bare``,
every long run of credential characters with digits and letters. Candidates are told
apart by the hash of their value, and every hash is counted by distinct repositories and
owners over the whole corpus. A value of many owners, or of many repositories even of one
owner, is a copied example; one of few owners and repositories that looks random is
live-looking. Base spans always stay; the method adds, as ``owned``, the bare runs that are
live-looking, of few owners and repositories, and touch no base span.

Hashes are first made distinct by repository and owner, so a value in a third of all rows
is one row per repository before it is counted. Spans are placed by running sums of gap and
match lengths over rows of their text; texts never enter a shuffle.

Defined cases: a null text is empty, a very long one is read whole; null repositories or
owners count as one of their own; repeated rows each have their spans and are of one owner;
spans that start together stand in the order of the kinds; an empty table gives an empty
result; other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notepairs.functions.text import settle
from notepairs.llm.common import text_or_empty
from notepairs.session import stage

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_CHARS = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
RUN = "[A-Za-z0-9+/_.=-]"
BARE_CHARS = 20
BARE = rf"(?<!{RUN})(?=[A-Za-z+/_.=-]*[0-9])(?=[0-9+/_.=-]*[A-Za-z]){RUN}{{{BARE_CHARS},}}"
KINDS = ("assign", "access", "hex", "bare")
#: A value of more owners, or in more repositories, than this is a copied example.
MAX_OWNERS = 2
MAX_REPOSITORIES = 6
#: A live-looking value has at least as many digits, letters and different characters.
LIVE_DIGITS = 4
LIVE_LETTERS = 4
LIVE_DIFFERENT = 10


def looks_live(value: Column) -> Column:
    """Whether a value looks random: long, digits and letters, many different characters."""
    digits, letters = F.regexp_count(value, F.lit("[0-9]")), F.regexp_count(value, F.lit("[A-Za-z]"))
    different = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= BARE_CHARS) & (digits >= LIVE_DIGITS) & (letters >= LIVE_LETTERS) & (different >= LIVE_DIFFERENT)


def _placed(gap: Column, value: Column):
    """Match number ``i`` with the length of the gap before it, its own length and its value."""
    return lambda m, i: F.struct(F.length(F.get(gap, i)).alias("gap"), F.length(m).alias("n"), F.get(value, i).alias("value"))


def candidates(rows: DataFrame) -> DataFrame:
    """Adds one array per kind to ``text``: the matches with their gap before, length and value."""
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, BARE)))
    every = rows.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in patterns.items()])
    every = settle(every, *[f"m_{k}" for k in KINDS])
    none = F.array().cast("array<string>")
    gaps = [F.when(F.size(f"m_{k}") > 0, F.split("text", p)).otherwise(none).alias(f"g_{k}") for k, p in patterns.items()]
    values = F.when(F.size("m_assign") > 0, F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))).otherwise(none)
    every = settle(every.select("*", *gaps, values.alias("v_assign")), *[f"g_{k}" for k in KINDS], "v_assign")
    for kind in KINDS:
        gap, value = F.col(f"g_{kind}"), F.col(f"v_{kind}" if kind == "assign" else f"m_{kind}")
        every = every.withColumn(kind, F.transform(f"m_{kind}", _placed(gap, value)))
    return every.drop("text", "v_assign", *[f"{x}_{k}" for x in "mg" for k in KINDS])


def scan(
    docs: DataFrame, *, repository: Column, owner: Column, id_column: str = "doc_id", text_column: str = "text",
    max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """Spans of every row: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned, n_live, n_examples``.

    ``n_live`` and ``n_examples`` count base spans whose value is live-looking and of few
    owners and repositories, or a copied example. ``repository`` and ``owner`` are columns of
    ``docs``; a repository is one of its owner.
    """
    rows = docs.select(
        docs[id_column].alias("doc_id"), repository.cast("string").alias("repository"), owner.cast("string").alias("owner"),
        text_or_empty(docs, text_column).alias("text"),
    ).withColumn("row", F.monotonically_increasing_id())
    found = stage(candidates(rows))
    number = {k: i for i, k in enumerate(KINDS)}
    marked = found.where(" OR ".join(f"size({k}) > 0" for k in KINDS)).select(
        "row", "repository", "owner",
        F.explode(F.array(*[F.struct(F.lit(number[k]).alias("kind"), F.col(k).alias("all")) for k in KINDS])).alias("k"),
    ).select("row", "repository", "owner", "k.kind", F.posexplode("k.all").alias("i", "m"))
    line = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = marked.withColumn("end", F.sum(F.col("m.gap") + F.col("m.n")).over(line))
    hits = stage(ends.select(
        "row", "repository", "owner", "kind", (F.col("end") - F.col("m.n")).alias("start"), "end",
        F.col("m.value").alias("value"), F.sha2("m.value", 256).alias("hash"),
    ).where((F.col("kind") > 0) | (F.length("value") >= ASSIGN_CHARS)))
    counts = (
        hits.select("hash", F.struct("repository", "owner").alias("place"), F.struct("owner").alias("holder")).distinct()
        .groupBy("hash").agg(F.countDistinct("place").alias("n_repositories"), F.countDistinct("holder").alias("n_owners"))
    )
    judged = hits.join(stage(counts), "hash").select(
        "row", "kind", "start", "end", ((F.col("n_owners") > max_owners) | (F.col("n_repositories") > max_repositories)).alias("example"), looks_live(F.col("value")).alias("live")
    )
    base = F.col("kind") < 3
    # Base spans come first among equal starts, so a run is compared with all that begin up to it.
    order = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    kept = judged.withColumn("free", free).where(base | (F.col("free") & F.col("live") & ~F.col("example")))
    names = F.array(*[F.lit(k) for k in (*KINDS[:3], "owned")])
    label = F.concat_ws(":", F.get(names, F.col("kind")), F.col("start").cast("string"), F.col("end").cast("string"))
    span = F.struct("start", "kind", label.alias("label"))
    joined = lambda kind: F.array_join(F.transform(F.filter("all", kind), lambda x: x["label"]), ",")
    per_row = kept.groupBy("row").agg(
        F.sort_array(F.collect_list(span)).alias("all"),
        *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k}") for i, k in enumerate((*KINDS[:3], "owned"))],
        F.count(F.when(base & F.col("live") & ~F.col("example"), 1)).alias("n_live"), F.count(F.when(base & F.col("example"), 1)).alias("n_examples"),
    ).select("*", joined(lambda x: x["kind"] < 3).alias("base"), joined(lambda x: F.lit(True)).alias("spans")).drop("all")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero("n_owned"), zero("n_live"), zero("n_examples"),
    )
