"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows from the root through domain, language and source. At each
node it is divided by the children's weights; a child never gets more than its
subtree can supply (its tokens times ``max_epochs``), and what a short child leaves
goes to its siblings. As a node never gets more than its children can supply, a
shortage reaches an ancestor only when the whole subtree is used up.

Each leaf then supplies whole epochs and, from one more epoch, the documents of a
seeded order whose running token sum stays within the rest of its budget.

The running sum never sorts a leaf: 4,096 order ranges per leaf are summed, twice
if need be, and only the rows of the one range that holds the cut are sorted.

Defined cases: a missing language, source or domain becomes the label ``(none)``; a
missing or blank text has no tokens, and such documents come with whole epochs or
at the head of a partial one; a leaf without tokens supplies nothing; repeated
identifiers are neighbours in the order; an empty table gives an empty result.
Weights are whole numbers; nodes with weight 0 supply nothing. Shares are rounded
down, so a node may leave fewer tokens unused than it has children. Input columns
named like an output are not used or are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.common import BROADCAST_ROWS, HASH_BITS, seeded_order
from millrace.session import written

LEVELS = ("domain", "lang", "source")
NONE = "(none)"
RANGE_BITS = 12
TOKEN = "[^ \\t\\n\\r]+"


@dataclass(frozen=True)
class Mix:
    """Weights by level and name (others weigh 1), the share of all tokens wanted, epochs, seed."""

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    share_percent: int = 80
    max_epochs: int = 3
    seed: int = 23


def source_domain(source: Column) -> Column:
    """The tree's first level for the given tables: the large crawl and the curated sources."""
    return F.when(source == "src0", "crawl").when(source.isNotNull(), "curated")


def _weight(mix: Mix, level: str) -> Column:
    named = mix.weights.get(level, {})
    start = F.lit(1)
    return reduce(lambda rest, kv: F.when(F.col(level) == kv[0], kv[1]).otherwise(rest), named.items(), start).cast("bigint")


def _divide(children: DataFrame, path: list[str], name: str) -> DataFrame:
    """Budget of each child from ``_budget`` of its parent: the smallest children by capacity for weight fill up first."""
    whole = Window.partitionBy(*path) if path else Window.partitionBy(F.lit(0))
    ordered = whole.orderBy(F.col("_cap") / F.col("_weight"), name)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    after = ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sized = children.where("_weight > 0").withColumns(
        {"_used": F.coalesce(F.sum("_cap").over(before), F.lit(0)), "_open": F.sum("_weight").over(after)}
    )
    full = sized.withColumn("_full", F.expr("_cap <= ((_budget - _used) * _weight) div _open"))
    rest = full.withColumns(
        {
            "_filled": F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(whole),
            "_others": F.sum(F.when(~F.col("_full"), F.col("_weight")).otherwise(0)).over(whole),
        }
    )
    share = F.when(F.col("_full"), F.col("_cap")).otherwise(F.expr("((_budget - _filled) * _weight) div greatest(_others, 1)"))
    return rest.withColumn("_share", share)


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, quota): the token budget of each leaf of (domain, lang, source, tokens)."""
    caps = leaves.withColumn("_cap", F.col("tokens") * mix.max_epochs)
    root = caps.agg(F.expr(f"least((sum(tokens) * {mix.share_percent}) div 100, sum(_cap))").cast("bigint").alias("_budget"))
    nodes = None
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[:depth])
        children = (
            caps.groupBy(*path, level)
            .agg(F.sum("_cap").cast("bigint").alias("_cap"), F.sum("tokens").alias("tokens"))
            .withColumn("_weight", _weight(mix, level))
        )
        with_budget = children.join(nodes, path) if path else children.withColumn("_budget", root.scalar())
        shared = _divide(with_budget, path, level)
        nodes = shared.select(*path, level, "tokens", F.col("_share").cast("bigint").alias("_budget"))
        if depth < len(LEVELS) - 1:
            nodes = nodes.drop("tokens")
    return nodes.withColumnRenamed("_budget", "quota")


def _prefix(rows: DataFrame, few: bool) -> DataFrame:
    """Rows of each leaf whose running token sum along ``_order`` stays within ``_rest``."""
    taken = []
    for level in (1, 2):
        shift = HASH_BITS - RANGE_BITS * level
        ranged = rows.withColumn("_range", F.shiftright("_order", shift))
        sums = ranged.groupBy(*LEVELS, "_range").agg(F.sum("tokens").alias("_sum"), F.first("_rest").alias("_rest"))
        running = Window.partitionBy(*LEVELS).orderBy("_range")
        ends = sums.withColumn("_end", F.sum("_sum").over(running))
        # The first range that ends beyond the budget holds the cut.
        cut = ends.where("_end > _rest").groupBy(*LEVELS).agg(
            F.min("_range").alias("_cut"), F.min_by(F.col("_end") - F.col("_sum"), "_range").alias("_before")
        )
        # A row per leaf, like the quotas, and so small enough for a broadcast if these are.
        placed = ranged.join(F.broadcast(cut) if few else cut, list(LEVELS), "left")
        taken.append(placed.where("_cut is null or _range < _cut"))
        rows = placed.where("_range = _cut").withColumn("_rest", F.col("_rest") - F.col("_before")).drop("_range", "_cut", "_before")
    running = Window.partitionBy(*LEVELS).orderBy("_order", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    taken.append(rows.withColumn("_end", F.sum("tokens").over(running)).where("_end <= _rest"))
    columns = ["doc_id", *LEVELS, "tokens", "_whole"]
    return reduce(DataFrame.unionByName, [t.select(*columns) for t in taken])


def mix_sources(
    docs: DataFrame, mix: Mix, domain: Column | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, domain, lang, source, tokens, epoch): the chosen documents, one row for each epoch that takes them."""
    label = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    facts = written(
        docs.select(
            F.col(key).alias("doc_id"),
            label(source_domain(F.col("source")) if domain is None else domain).alias("domain"),
            label(F.col("lang")).alias("lang"),
            label(F.col("source")).alias("source"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("bigint").alias("tokens"),
        ),
        "mix-facts",
    )
    leaves = facts.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"))
    shares = leaf_budgets(leaves, mix).where("quota > 0")
    quotas = written(
        shares.select(*LEVELS, F.expr("quota div tokens").alias("_whole"), F.expr("quota % tokens").alias("_rest")),
        "mix-quotas",
    )
    few = quotas.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = facts.join(F.broadcast(quotas) if few else quotas, list(LEVELS))
    wholes = rows.where("_whole > 0").select(
        "doc_id", *LEVELS, "tokens", F.explode(F.sequence(F.lit(0), F.col("_whole").cast("int") - 1)).alias("epoch")
    )
    order = seeded_order(F.concat_ws(":", F.lit(str(mix.seed)), F.col("_whole").cast("string")), F.col("doc_id"))
    partial = _prefix(rows.where("_rest > 0").withColumn("_order", order), few)
    return wholes.unionByName(partial.select("doc_id", *LEVELS, "tokens", F.col("_whole").cast("int").alias("epoch")))


def mixed_documents(docs: DataFrame, mix: Mix, domain: Column | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The chosen rows of ``docs``, with their columns; needs one epoch and unique keys, so that no row is repeated."""
    if mix.max_epochs != 1:
        raise ValueError("rows can be kept or left out, not repeated: set max_epochs to 1")
    chosen = mix_sources(docs, mix, domain, key, text).select(F.col("doc_id").alias("_key")).distinct()
    return docs.join(chosen, docs[key].eqNullSafe(chosen["_key"]), "left_semi")


def mix_sql(mix: Mix) -> str:
    """The same result in SQL, with plain running sums over whole leaves."""

    def weight(level: str) -> str:
        whens = " ".join(f"when '{name}' then {w}" for name, w in mix.weights.get(level, {}).items())
        return f"case {level} {whens} else 1 end" if whens else "1"

    ctes = []
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[:depth])
        part = f"partition by {', '.join(path)}" if path else ""
        using = f"join n{depth} using ({', '.join(path)})" if path else "cross join n0"
        up_to = ", ".join([*path, level])
        ctes.append(f"""
c{depth} as (select {up_to}, sum(tokens)::bigint as tokens, sum(tokens)::bigint * {mix.max_epochs} as cap, {weight(level)} as w
  from leaves group by {up_to}),
o{depth} as (select *, cap <= (budget - used) * w // open_w as is_full from (select *,
    coalesce(sum(cap) over (u rows between unbounded preceding and 1 preceding), 0)::bigint as used,
    sum(w) over (u rows between current row and unbounded following)::bigint as open_w
  from c{depth} {using} where w > 0 window u as ({part} order by cap / w, {level}))),
n{depth + 1} as (select {up_to}, tokens as leaf_tokens, (case when is_full then cap else
    (budget - sum(case when is_full then cap else 0 end) over p) * w
      // greatest(sum(case when is_full then 0 else w end) over p, 1) end)::bigint as budget
  from o{depth} window p as ({part}))""".replace(" tokens as leaf_tokens,", " tokens as leaf_tokens," if depth == len(LEVELS) - 1 else ""))
    return f"""
with facts as (select doc_id, case when source = 'src0' then 'crawl' when source is not null then 'curated' else '{NONE}' end as domain,
    coalesce(lang, '{NONE}') as lang, coalesce(source, '{NONE}') as source,
    coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0)::bigint as tokens from documents),
leaves as (select domain, lang, source, sum(tokens)::bigint as tokens from facts group by domain, lang, source),
n0 as (select least(sum(tokens) * {mix.share_percent} // 100, sum(tokens) * {mix.max_epochs})::bigint as budget from leaves),
{",".join(ctes)},
q as (select domain, lang, source, budget // leaf_tokens as whole, budget % leaf_tokens as rest from n{len(LEVELS)} where budget > 0),
r as (select *, sum(tokens) over (partition by domain, lang, source order by ord, doc_id, tokens rows unbounded preceding) as run
  from (select facts.*, whole, rest,
      ('0x' || substr(md5('{mix.seed}:' || whole || ':' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as ord
    from facts join q using (domain, lang, source)))
select doc_id, domain, lang, source, tokens, epoch::int as epoch
from (select *, unnest(range(whole)) as epoch from r)
union all
select doc_id, domain, lang, source, tokens, whole::int as epoch from r where rest > 0 and run <= rest
"""
