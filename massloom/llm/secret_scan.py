"""Secret scan: patterns find candidates, their ownership over the whole corpus tells what they are.

Everything is DataFrame functions. One pass over the texts keeps only the matches; what follows
works on that small table. A match's place comes from the lengths of the pieces between matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.common import kept, with_row_id

KEYWORD = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
)
#: kind: (pattern, group that holds the secret, its least length). The length is tested after the
#: match for ``assign``, as a short value must still use up its characters; the runs of the others
#: are whole either way. ``loose`` is any long mixed token: reported only if its owners give it away.
KINDS = {
    "assign": (KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"(AKIA[A-Z0-9]{12,})", 1, 16),
    "hex": (r"([0-9a-f]{32,})", 1, 32),
    "loose": (r"([A-Za-z0-9+/_-]{24,})", 1, 24),
}
BASE = ("assign", "access", "hex")


def _found(text: Column, kind: str) -> Column:
    pattern, group, _ = KINDS[kind]
    rows = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
        F.transform(F.split(text, pattern, -1), F.char_length).alias("gap"),
    )
    rows = F.filter(
        F.transform(rows, lambda r, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), r["gap"].alias("gap"),
            F.char_length(r["match"]).alias("length"), r["value"].alias("value"))),
        lambda r: r["length"].isNotNull(),  # the piece after the last match
    )
    return F.when(text.rlike(pattern), rows)


def findings(docs: DataFrame, doc_id: str, text: str, repo: Column, owner: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, finds): every row with a ``uid``; every match with its place and secret's hash."""
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = with_row_id(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), repo.cast("string").alias("repo"), owner.cast("string").alias("owner")
    ))
    empty = F.array().cast("array<struct<kind:string,i:int,gap:int,length:int,value:string>>")
    rows = kept(rows.select("uid", "doc_id", "repo", "owner", F.concat(
        *[F.coalesce(_found(body, k), empty) for k in KINDS]).alias("found")), "secret-rows")
    each = rows.select("uid", "repo", "owner", F.explode("found").alias("m")).select("uid", "repo", "owner", "m.*")
    before = Window.partitionBy("uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("length")).over(before))
    least = F.create_map(*[F.lit(x) for k, (_, _, n) in KINDS.items() for x in (k, n)])
    each = each.where(F.char_length("value") >= least[F.col("kind")])
    each = each.where((F.col("kind") != "loose") | (F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")))
    return rows, each.select(
        "uid", "repo", "owner", "kind", (F.col("end") - F.col("length")).alias("start"), "end",
        F.sha2("value", 256).alias("hash"), entropy(F.col("value")).alias("bits"), F.col("value").rlike("[0-9]").alias("digit"))


def entropy(value: Column) -> Column:
    """Bits of entropy a character."""
    size = F.char_length(value)
    share = F.transform(
        F.array_distinct(F.filter(F.split(value, ""), lambda c: c != "")),
        lambda c: (size - F.char_length(F.replace(value, c, F.lit("")))) / size,
    )
    return F.aggregate(share, F.lit(0.0), lambda s, p: s - p * F.log2(p))


def ownership(finds: DataFrame, copied_owners: int, copied_repos: int, least_bits: float) -> DataFrame:
    """(hash, repos, owners, bits, verdict) of each distinct secret over the whole corpus.

    Copies are merged by (hash, repo, owner) before the shuffle, so a secret in a third of all rows
    arrives as one row per task. ``copied``: in at least ``copied_owners`` owners or
    ``copied_repos`` repositories; ``live``: else, with ``least_bits`` of entropy a character and a
    digit; ``weak``: the rest. A null repository or owner counts as one value of its own.
    """
    facts = [F.min("bits").alias("bits"), F.min("digit").alias("digit")]
    spots = finds.groupBy("hash", F.coalesce("repo", F.lit("\0")).alias("repo"), F.coalesce("owner", F.lit("\0")).alias("owner")).agg(*facts)
    owners = spots.groupBy("hash", "owner").agg(*facts, F.count("*").alias("repos"))
    each = owners.groupBy("hash").agg(*facts, F.sum("repos").alias("repos"), F.count("*").alias("owners"))
    verdict = (
        F.when((F.col("owners") >= copied_owners) | (F.col("repos") >= copied_repos), "copied")
        .when((F.col("bits") >= least_bits) & F.col("digit"), "live").otherwise("weak")
    )
    return each.select("hash", "repos", "owners", "bits", verdict.alias("verdict"))


def secret_spans(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repo: Column | None = None, owner: Column | None = None,
    copied_owners: int = 3, copied_repos: int = 5, least_bits: float = 3.0,
) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): the rows (uid, doc_id) and every reported span
    (uid, kind, start, end, hash, repos, owners, verdict).

    All matches of the base kinds are reported. A loose token is reported only if it lies outside
    every base match and its ownership makes it a live credential. Null text counts as empty;
    repeated rows are scanned each for itself; other columns of ``docs`` are not looked at.
    """
    rows, finds = findings(docs, doc_id, text, F.col("source") if repo is None else repo, F.col("source") if owner is None else owner)
    finds = kept(finds, "secret-finds")
    owned = finds.join(ownership(finds, copied_owners, copied_repos, least_bits), "hash")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    upto = Window.partitionBy("uid").orderBy("start", order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("kind") != "loose", F.col("end"))).over(upto)
    spans = owned.withColumn("covered", covered).where(
        (F.col("kind") != "loose") | ((F.col("verdict") == "live") & (F.coalesce("covered", F.lit(0)) <= F.col("start"))))
    return rows.select("uid", "doc_id"), spans.select(
        "uid", "kind", order.alias("order"), "start", "end", "hash", "repos", "owners", "verdict")


def secret_digest(docs: DataFrame, **options) -> DataFrame:
    """Per input row: counts by kind, the digest of the base spans, all spans, and how many are live
    or copied. A row without text or match has zeros and empty strings."""
    rows, spans = secret_spans(docs, **options)
    note = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    lists = spans.groupBy("uid").agg(
        F.array_sort(F.collect_list(F.struct("start", "order", note.alias("note")))).alias("all"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        *[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("live", "copied")],
    )
    joined = lambda items: F.array_join(F.transform(items, lambda s: s["note"]), ",")
    base = F.filter("all", lambda s: s["order"] <= len(BASE))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    lists = lists.withColumns({"base": joined(base), "spans": joined(F.col("all"))})
    return rows.join(lists, "uid", "left").select(
        "doc_id", *[zero(f"n_{k}") for k in BASE], F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero("n_live"), zero("n_copied"))


MASKS = {"live": "[credential]", "copied": "[example credential]", "weak": "[password]"}


def mask_secrets(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every reported span replaced by what it is; ``n_chars``, if there, is renewed.

    Overlapping spans are merged and take the gravest name. Texts without a candidate, null and empty
    ones too, pass untouched and are not shuffled. Rows are found again by (doc_id, hash of the
    text), null ids by their own: rows alike in both are masked alike. Columns keep their names,
    whatever they are; without ``repo`` and ``owner`` both are the column ``source``.
    """
    columns, text, doc_id = docs.columns, options.pop("text", "text"), options.pop("doc_id", "doc_id")
    repo, owner = (options.pop(k, None) for k in ("repo", "owner"))
    any_kind = "|".join(f"(?:{KINDS[k][0]})" for k in KINDS)
    has = F.coalesce(F.col(text).rlike(any_kind), F.lit(False))
    clean, suspect = docs.where(~has), docs.where(has)
    key = F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("text_hash"))
    places = [F.col("source") if c is None else c for c in (repo, owner)]
    rows, spans = secret_spans(
        suspect.select(key.alias("doc_id"), F.col(text).alias("text"), places[0].alias("repo"), places[1].alias("owner")),
        repo=F.col("repo"), owner=F.col("owner"), **options)
    grave = F.array_position(F.array(*map(F.lit, MASKS)), F.col("verdict"))
    by_start = Window.partitionBy("uid").orderBy("start", "end")
    spans = spans.withColumn("reach", F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)))
    spans = spans.withColumn("part", F.count_if(F.coalesce(F.col("reach") <= F.col("start"), F.lit(True))).over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
    parts = spans.groupBy("uid", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min(grave).alias("grave"))
    back = Window.partitionBy("uid").orderBy("part")
    parts = parts.withColumn("from", F.coalesce(F.lag("end").over(back), F.lit(0)))
    lists = parts.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "from", "end", "grave"))).alias("parts"))
    wanted = rows.join(lists, "uid").groupBy(F.col("doc_id").alias("of")).agg(F.min("parts").alias("parts"))
    # the whole row travels as one column, so no name can clash
    whole = suspect.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    body = F.col("row").getField(text)
    names = F.array(*[F.lit(m) for m in MASKS.values()])
    pieces = F.transform("parts", lambda p: F.concat(
        F.substr(body, (p["from"] + 1).cast("int"), (p["start"] - p["from"]).cast("int")), F.element_at(names, p["grave"].cast("int"))))
    rest = F.substr(body, (F.element_at("parts", -1)["end"] + 1).cast("int"))
    masked = F.when(F.col("parts").isNull(), body).otherwise(F.concat(F.array_join(pieces, ""), rest))
    joined = whole.join(wanted, F.col("key").eqNullSafe(F.col("of")), "left").withColumn("masked", masked)
    size = lambda c: F.char_length("masked").cast(docs.schema[c].dataType).alias(c)
    return clean.unionByName(joined.select(*[
        F.col("masked").alias(c) if c == text else size(c) if c == "n_chars" else F.col("row").getField(c).alias(c) for c in columns]))
