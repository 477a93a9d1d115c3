"""Secret scan with corpus-wide ownership frequency (DataFrame functions only).

1. Candidates: the matches of three fixed patterns in every whole text, with
   code-point offsets.  ``split`` and ``regexp_extract_all`` run the same
   pattern, so the running sum of the lengths of the pieces and of the matches
   gives each match its place.  The running sums are taken in runs of ``RUN``
   and carried on from run to run, so a text of n matches costs about n * RUN
   steps, not n * n.
2. Ownership: the hash of each candidate value is counted over distinct
   repositories (here a document) and distinct owners (here its source).  The
   counts are nested, (value, owner, repository) -> (value, owner) -> value,
   each step pre-aggregated, so a value in a third of all rows never meets in
   one task.
3. Verdict: a value of at least ``copied_owners`` owners is a widely copied
   example (span kind ``copied``).  Of the others, those that look live (enough
   distinct characters, letters and digits) are credentials: ``live`` under one
   owner, ``shared`` under several.  Verdict spans cover the value and are added
   to the base spans, which all stay.

Defined cases: a null text is empty and has no spans; a null owner counts as
one owner of its own; repeated rows give repeated result rows and count once as
a repository; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import fresh, written

#: Fixed values of the contract: kind, pattern, group of the value, least length
#: of that group.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = [
    ("assign", ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
#: A text without a match of this has no match of the three patterns.
ANY = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{12}|[0-9a-f]{32}"""

#: Verdicts, in the order of their spans after those of ``KINDS``.
VERDICTS = ["copied", "live", "shared"]
#: Verdicts of values to be masked.
CREDENTIALS = ["live", "shared"]
#: Numbers of a run of ``running``.
RUN = 256


def bound(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once however often it is used:
    the optimizer puts the expression of a column into lambdas that use it, where
    it would be evaluated for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, merge) -> Column:
    """Running totals of an array of longs (none negative) under ``merge``, an
    addition or a maximum."""
    zero = F.lit(0).cast("long")
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), zero)
    total = lambda a: F.aggregate(
        a, F.expr("cast(array() as array<long>)"), lambda out, x: F.concat(out, F.array(merge(last(out), x)))
    )

    def runs(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor(F.size(a) / RUN).cast("int"))
        return F.transform(starts, lambda i: total(F.slice(a, i * RUN + 1, F.lit(RUN))))

    def joined(parts: Column) -> Column:
        before = F.concat(F.array(zero), total(F.transform(parts, last)))
        carried = F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda run, c: F.transform(run, lambda x: merge(c, x)))
        return F.flatten(carried)

    return bound(values, lambda a: bound(runs(a), joined))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def kind_spans(k: int) -> Column:
    """Spans of the kind numbered ``k`` from its stops, matches and values."""
    kind, _, _, least = KINDS[k]
    one = F.arrays_zip(F.col(f"_stop{k}").alias("stop"), F.col(f"_hit{k}").alias("hit"), F.col(f"_value{k}").alias("value"))
    all_ = F.transform(
        one,
        lambda x: F.struct(
            (x["stop"] - F.length(x["hit"])).alias("start"),
            F.lit(k).alias("k"),
            F.lit(kind).alias("kind"),
            x["stop"].alias("stop"),
            (x["stop"] - F.length(x["value"])).alias("vstart"),
            x["value"].alias("value"),
        ),
    )
    return F.filter(all_, lambda s: F.length(s["value"]) >= least)


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """(doc_id, owner, twin, spans): all base spans of a document, structs (start,
    k, kind, stop, vstart, value) by start, then kind.  ``twin`` tells apart rows
    that share an id.

    ``access`` and ``hex`` carry their least length in the pattern: a maximal run
    below it holds no other match, so this equals dropping short matches.  The
    value always ends its match."""
    found = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(owner_col).cast("string").alias("owner"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_t"),
    )
    any_ = F.col("_t").rlike(ANY)
    none = F.expr("cast(array() as array<string>)")
    lists = []
    for k, (_, pattern, group, _) in enumerate(KINDS):
        p = F.lit(pattern)
        lists += [
            F.when(any_, F.split("_t", p, -1)).otherwise(none).alias(f"_gap{k}"),
            F.when(any_, F.regexp_extract_all("_t", p, F.lit(0))).otherwise(none).alias(f"_hit{k}"),
            F.when(any_, F.regexp_extract_all("_t", p, F.lit(group))).otherwise(none).alias(f"_value{k}"),
        ]
    found = found.select("doc_id", "owner", F.xxhash64("_t", "owner").alias("twin"), *lists)
    for k in range(len(KINDS)):
        steps = F.zip_with(
            F.slice(f"_gap{k}", F.lit(1), F.size(f"_hit{k}")), f"_hit{k}", lambda gap, hit: (F.length(gap) + F.length(hit)).cast("long")
        )
        found = found.withColumn(f"_stop{k}", running(steps, _plus)).drop(f"_gap{k}")
    return found.select("doc_id", "owner", "twin", F.sort_array(F.concat(*map(kind_spans, range(len(KINDS))))).alias("spans"))


def ownership(hits: DataFrame) -> DataFrame:
    """(value_hash, n_repos, n_owners) from rows (value_hash, owner, doc_id)."""
    return (
        hits.groupBy("value_hash", "owner", "doc_id")
        .agg(F.lit(1).alias("one"))
        .groupBy("value_hash", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("value_hash")
        .agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))
    )


def looks_live(value: Column, distinct_chars: int) -> Column:
    return (
        (F.size(F.array_distinct(F.split(value, ""))) >= distinct_chars) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    )


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    copied_owners: int = 3,
    distinct_chars: int = 8,
) -> DataFrame:
    """(doc_id, twin, spans): per document its base spans and the verdict spans
    (``VERDICTS``), an array of (start, k, kind, stop, n_repos, n_owners)."""
    found = written(find_candidates(docs, id_col, text_col, owner_col), "secret_candidates")
    hits = (
        found.where(F.size("spans") > 0)
        .select("doc_id", "owner", "twin", F.explode("spans").alias("s"))
        .select("doc_id", "owner", "twin", "s", F.xxhash64("s.value").alias("value_hash"))
    )
    judged = (
        hits.select("doc_id", "twin", "s", "value_hash")
        .join(ownership(hits), "value_hash")
        .select(
            "doc_id",
            "twin",
            "s",
            "n_repos",
            "n_owners",
            F.when(F.col("n_owners") >= copied_owners, "copied")
            .when(looks_live(F.col("s.value"), distinct_chars), F.when(F.col("n_owners") == 1, "live").otherwise("shared"))
            .alias("verdict"),
        )
    )
    counts = [F.col("n_repos"), F.col("n_owners")]
    base = F.struct("s.start", "s.k", "s.kind", "s.stop", *counts)
    verdict = F.struct(
        F.col("s.vstart").alias("start"),
        (F.array_position(F.array(*map(F.lit, VERDICTS)), F.col("verdict")) + len(KINDS) - 1).cast("int").alias("k"),
        F.col("verdict").alias("kind"),
        F.col("s.stop").alias("stop"),
        *counts,
    )
    both = F.when(F.col("verdict").isNull(), F.array(base)).otherwise(F.array(base, verdict))
    per_doc = (
        judged.select("doc_id", "twin", F.explode(both).alias("one"))
        .groupBy("doc_id", "twin")
        .agg(F.sort_array(F.collect_set("one")).alias("all"))
        .select(F.col("doc_id").alias("_id"), F.col("twin").alias("_twin"), "all")
    )
    none = F.expr("cast(array() as array<struct<start:long,k:int,kind:string,stop:long,n_repos:long,n_owners:long>>)")
    same = found["doc_id"].eqNullSafe(per_doc["_id"]) & (found["twin"] == per_doc["_twin"])
    return found.join(per_doc, same, "left").select(
        "doc_id", "twin", F.coalesce("all", none).alias("spans"), F.col("spans").alias("base")
    )


MASK = "[SECRET]"


def mask_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    count_col: str | None = None,
    mask: str = MASK,
) -> DataFrame:
    """``docs`` with the spans of ``CREDENTIALS`` in the text replaced by
    ``mask``, same columns; ``count_col``, if given, is set to the new number of
    characters of a changed text.  Rows without such a span keep every column as
    it was; only rows with candidates are shuffled.

    Spans that overlap are masked once.  Texts are cut in UTF-32, where a place
    is found without reading what stands before it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.where(~text.rlike(ANY))
    suspect = docs.where(text.rlike(ANY))
    key, twin, spans, reach = (fresh(docs, name) for name in ("_live_id", "_live_twin", "_live_spans", "_live_reach"))
    live = (
        scan_secrets(suspect, id_col, text_col, owner_col)
        .select("doc_id", "twin", F.filter("spans", lambda s: s["kind"].isin(CREDENTIALS)).alias(spans))
        .where(F.size(spans) > 0)
        .select(F.col("doc_id").alias(key), F.col("twin").alias(twin), F.col(spans).alias(spans))
        .distinct()
        .withColumn(reach, running(F.transform(spans, lambda s: s["stop"]), F.greatest))
    )
    same = suspect[id_col].cast("long").eqNullSafe(F.col(key)) & (
        F.xxhash64(text, F.col(owner_col).cast("string")) == F.col(twin)
    )
    mark = F.lit(b"\x00\x00\xfe\xff")  # read as the mark of the encoding, so that one in the text stays

    def cut(wide: Column, start: Column, stop: Column) -> Column:
        part = F.substr(wide, (start * 4 + 1).cast("int"), ((stop - start) * 4).cast("int"))
        return F.decode(F.concat(mark, part), "UTF-32")

    def masked_text(wide: Column) -> Column:
        before = F.concat(F.array(F.lit(0).cast("long")), F.col(reach))
        pieces = F.zip_with(
            spans,
            F.slice(before, F.lit(1), F.size(spans)),
            lambda s, at: F.when(s["start"] >= at, F.concat(cut(wide, at, s["start"]), F.lit(mask))).otherwise(""),
        )
        tail = cut(wide, F.element_at(reach, -1), (F.length(wide) / 4).cast("long"))
        return F.concat(F.array_join(pieces, ""), tail)

    changed = bound(F.encode(text, "UTF-32"), masked_text)
    masked = suspect.join(live, same, "left").withColumn(
        text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(changed)
    )
    if count_col in docs.columns:
        kind = docs.schema[count_col].dataType
        masked = masked.withColumn(
            count_col, F.when(F.col(spans).isNull(), F.col(count_col)).otherwise(F.length(F.col(text_col)).cast(kind))
        )
    return plain.unionByName(masked.select(*docs.columns))


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def secret_digest(docs: DataFrame, **options) -> DataFrame:
    """The contract's row per document, from ``scan_secrets``."""
    scanned = scan_secrets(docs, **options)
    number = lambda col, kind: F.size(F.filter(col, lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        *[number(F.col("base"), kind).alias(f"n_{kind}") for kind, *_ in KINDS],
        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
        *[number(F.col("spans"), kind).alias(f"n_{kind}") for kind in VERDICTS],
    )


_ORACLE_KIND = """
select doc_id, owner, rid, {k} as k, '{kind}' as kind,
       list_sum([length(p) for p in pieces[1:i]]) + list_sum([length(h) for h in hits[1:i]])::bigint as stop,
       length(hits[i]) as n, vals[i] as value
from (select doc_id, owner, rid, string_split_regex(t, '{pattern}') as pieces,
             regexp_extract_all(t, '{pattern}', 0) as hits,
             regexp_extract_all(t, '{pattern}', {group}) as vals
      from docs where regexp_matches(t, '{pattern}')) m, unnest(range(1, len(hits) + 1)) as u(i)
where length(vals[i]) >= {least}"""


def oracle(copied_owners: int = 3, distinct_chars: int = 8) -> str:
    """DuckDB SQL for ``secret_digest``."""
    kinds = "\nunion all\n".join(
        _ORACLE_KIND.format(k=k, kind=kind, pattern=p.replace("'", "''"), group=g, least=n)
        for k, (kind, p, g, n) in enumerate(KINDS)
    )
    return f"""
with docs as (select doc_id, source as owner, coalesce(text, '') as t, row_number() over () as rid from documents),
hits as ({kinds}),
own as (select value, count(distinct coalesce(owner, chr(0))) as n_owners from hits group by value),
base as (select rid, (stop - n)::bigint as start, k, kind, stop::bigint as stop, length(value) as vl, h.value, n_owners
         from hits h join own using (value)),
verdicts as (select rid, stop - vl as start, {len(KINDS)} + list_position({VERDICTS}, kind) - 1 as k, kind, stop
         from (select *, case when n_owners >= {copied_owners} then 'copied'
                              when regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')
                                   and len(list_distinct(string_split(value, ''))) >= {distinct_chars}
                              then case when n_owners = 1 then 'live' else 'shared' end end as kind
               from (select rid, stop, vl, value, n_owners from base)) where kind is not null),
spans as (select rid, start, k, kind, stop, true as is_base from base
          union all select distinct rid, start, k, kind, stop, false from verdicts),
per as (select rid, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
               count(*) filter (kind = 'hex') as n_hex,
               string_agg(kind || ':' || start || ':' || stop, ',' order by start, k, stop) filter (is_base) as b,
               string_agg(kind || ':' || start || ':' || stop, ',' order by start, k, stop) as s,
               count(*) filter (kind = 'copied') as n_copied, count(*) filter (kind = 'live') as n_live,
               count(*) filter (kind = 'shared') as n_shared
        from spans group by rid)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
       coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(b, '')) as base_sha256, coalesce(s, '') as spans,
       coalesce(n_copied, 0)::bigint as n_copied, coalesce(n_live, 0)::bigint as n_live,
       coalesce(n_shared, 0)::bigint as n_shared
from docs left join per using (rid)
"""
