"""Line deduplication by an exact set-similarity join, in DataFrame operations only.

A line's tokens are its distinct runs of five words (all words, if fewer). Lines with
equal token sets are one class. Classes are linked if their Jaccard similarity reaches
``percent``. A line goes if an earlier one (smaller id, or same id further up) is of
its class or of a linked class.

The join takes as prefix the tokens, in one fixed order, that two similar lines can't both lack; the
order is that of their hashes. Prefix tokens that no other line posts go first, which is nearly all. The full sets of the
lines that post a shared one are computed again and their tokens counted, so that the number of
tokens a line has to itself is known. They are the rarest and stand before all others, as if the prefix had been
ordered by rarity: prefixes are joined on equal tokens, and the join itself drops what the lengths or the
positions of the shared token, behind the tokens of one line only, rule out. So copies with many edits don't meet.
Parities of the tokens drop nearly all pairs that are left and not alike, and the rest is verified on the full sets. Of most lines
only the prefix is shuffled.

Defined cases: lines without words stay; a missing text has no lines; an empty text has
one blank line; rows that share an id count as one place, so equal lines at equal numbers there don't
remove each other; a missing id comes last (the largest number stands for it); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.fingerprints import _let, _upto
from millrace.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"
GAP = "[ \\t\\n\\x0b\\f\\r]+"
MARKS = 4
HOT = 16
LAST_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Similar:
    percent: int = 80
    width: int = 5


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def _words(line: Column) -> Column:
    """The words of a line, A-Z in lower case; a line that needs neither trimming nor other gaps is cut at each blank."""
    # Lines of single bytes have no other capitals, so the quick function agrees on them.
    plain = F.when(F.octet_length(line) == F.char_length(line), F.lower(line)).otherwise(F.translate(line, UPPER, LOWER))
    odd = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for blank in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains(line, F.lit(blank))
    return F.when(odd, F.split(_trimmed(plain), GAP)).otherwise(F.split(plain, " "))


def tokens(line: Column, width: int) -> Column:
    """Distinct tokens of a line in the order of their hashes."""

    def runs(p: Column) -> Column:
        def token(first: Column, i: Column) -> Column:
            return F.xxhash64(first, *[F.get(p, i + j) for j in range(1, width)])

        # The last places have no full run of words.
        return F.sort_array(F.array_distinct(F.transform(F.slice(p, F.lit(1), F.size(p) - (width - 1)), token)))

    def of(h: Column) -> Column:
        return F.when(F.size(h) >= width, runs(h)).otherwise(F.array(F.xxhash64(h)))

    found = _let(F.transform(_words(line), lambda w: F.xxhash64(w)), of)
    return F.when(_trimmed(line) != "", found).otherwise(F.array().cast("array<bigint>"))


def _prefix_size(n: Column, percent: int) -> Column:
    """Tokens of a set of n of which a similar set holds one at least: n - ceil(n * percent / 100) + 1."""
    return (n - F.ceil(n * percent / F.lit(100.0)) + 1).cast("int")


def line_classes(docs: DataFrame, similar: Similar, key: str, text: str) -> DataFrame:
    """(class, id, line, n, prefix): each distinct token set with its first place and prefix."""
    lines = docs.select(F.coalesce(F.col(key), F.lit(LAST_ID)).alias("id"), F.posexplode(F.split(text, "\n", -1)).alias("line", "words"))
    # Blank lines are left out by their text: a condition on the tokens would compute these twice.
    found = lines.where(_trimmed(F.col("words")) != "").withColumn("tokens", tokens(F.col("words"), similar.width))
    name = F.struct(F.xxhash64("tokens").alias("h"), F.xxhash64(F.lit(1), F.col("tokens")).alias("g"))
    n = F.size("tokens")
    place = F.struct("id", "line", n.alias("n"), F.slice("tokens", F.lit(1), _prefix_size(n, similar.percent)).alias("prefix"))
    firsts = found.select(name.alias("class"), place.alias("place")).groupBy("class").agg(F.min("place").alias("place"))
    return firsts.select("class", "place.*")


def _posted(classes: DataFrame) -> DataFrame:
    """(id, line, n, at, token): the prefixes token by token."""
    # A single token is shared by one class only.
    return classes.where("n > 1").select("id", "line", "n", F.posexplode("prefix").alias("at", "token"))


def _shared(posted: DataFrame, similar: Similar) -> DataFrame:
    """Of the posted tokens those that another line posts, too, of a number of tokens that lets both be alike."""
    posts = F.count(F.lit(1)).over(Window.partitionBy("token"))
    # Logarithms in millionths, the bound a little wider for their rounding.
    far = math.ceil(math.log(100 / similar.percent) * 1_000_000) + 2
    length = F.floor(F.log("n") * 1_000_000)
    near = F.count(F.lit(1)).over(Window.partitionBy("token").orderBy(length).rangeBetween(-far, far))
    again = posted.withColumn("posts", posts).where("posts > 1").drop("posts")
    return again.withColumn("near", near).where("near > 1")


def _placed(shared: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """The shared tokens that leave room, with the marks of their line; ``hot`` ones, which more than ``HOT`` lines
    post, with their least position (``least``) once the tokens that only one line with hot ones has stand first, and
    the hot ones of the line before them."""
    hot = (F.col("near") > HOT) & ~F.col("mixed")
    # Cut to 32 bits, which can only make a token of one set look shared.
    spread = sets.where(hot).select("place", F.explode("tokens").alias("token")).select("place", F.shiftright("token", 32).cast("int").alias("t"))
    counted = spread.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("place")).where("n = 1")
    alone = counted.groupBy("place").agg(F.count(F.lit(1)).cast("int").alias("alone"))
    own = sets.select("id", "line", "place", "mixed", "marks", F.col("n").alias("size"))
    rows = shared.join(own, ["id", "line"]).withColumn("hot", hot)
    posts = F.count(F.lit(1)).over(Window.partitionBy("token"))
    line = Window.partitionBy("place").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    known = F.collect_list(F.when(F.col("posts") > 1, F.col("token"))).over(line)
    many = rows.where("hot").withColumn("posts", posts).withColumn("before", known)
    least = F.greatest(F.col("at"), F.coalesce("alone", F.lit(0)) + F.size("before"))
    # The least that a line must share with any is its part of the shortest that can be alike.
    ranked = many.join(alone, "place", "left").withColumn("least", least).where(F.expr(f"(n - least) * 100 >= n * {similar.percent}"))
    cold = rows.where("not hot").withColumns({"least": F.col("at"), "before": F.array().cast("array<bigint>")})
    both = ranked.select(*rows.columns, "least", "before").unionAll(cold.select(*rows.columns, "least", "before"))
    return both.drop("near", "place", "mixed")


def _candidates(classes: DataFrame, similar: Similar) -> DataFrame:
    """(c_id, c_line, d_id, d_line): first places of classes that may be linked, the later one as ``c``."""
    return _meetings(_posted(classes), similar, {side: f"{side}.at" for side in "cd"})


def _meetings(posted: DataFrame, similar: Similar, at: dict[str, str], alike: Column | None = None) -> DataFrame:
    """Pairs of places by a posted token whose position, as ``at`` tells it, leaves room; ``alike`` must hold, too."""
    t = similar.percent
    late, early = posted.alias("c"), posted.alias("d")
    earlier = F.expr("c.token = d.token and (d.id < c.id or d.id = c.id and d.line < c.line)")
    lengths = F.expr(f"100 * least(c.n, d.n) >= {t} * greatest(c.n, d.n)")
    places = [F.col(f"{side}.{x}").alias(f"{side}_{x}") for side in "cd" for x in ("id", "line")]
    # The first token that two sets share leaves room for all the tokens they must share, in either: of a
    # similar pair it is met, so other meetings go before they are moved.
    room = F.expr(f"least(c.n - {at['c']}, d.n - {at['d']}) * {100 + t}L >= (c.n + d.n) * {t}L")
    met = earlier & lengths & room if alike is None else earlier & lengths & room & alike
    return late.join(early, met).select(*places).distinct()


def _near(placed: DataFrame, similar: Similar) -> DataFrame:
    """The candidates whose marks let them be alike.

    A token that only one of two sets holds changes one parity, so the parities that differ
    are a lower bound of such tokens: most pairs go by it in the join, before they are moved.
    """
    differ = sum((F.bit_count(F.get("c.marks", F.lit(k)).bitwiseXOR(F.get("d.marks", F.lit(k)))) for k in range(1, MARKS)),
                 F.bit_count(F.get("c.marks", F.lit(0)).bitwiseXOR(F.get("d.marks", F.lit(0)))))
    # With n tokens in both together, of which u in one set only, the similarity is (n - u) / (n + u).
    n = F.col("c.size") + F.col("d.size")
    alike = (n - differ) * 100 >= (n + differ) * similar.percent
    # Lines meet by the first hot token they share, not by each.
    alike = alike & ~F.arrays_overlap("c.before", "d.before")
    return _meetings(placed, similar, {side: f"if(c.hot and d.hot, {side}.least, {side}.at)" for side in "cd"}, alike)


def _marks(found: Column) -> Column:
    """For each of ``MARKS`` parts of the tokens the parity of their counts in 64 slots, as a number."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def part(k: int) -> Column:
        mine = F.filter(found, lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(MARKS - 1)) == k)
        return F.aggregate(mine, zero, lambda a, x: a.bitwiseXOR(F.call_function("shiftleft", one, x.bitwiseAND(F.lit(63)).cast("int"))))

    return F.array(*[part(k) for k in range(MARKS)])


def _sets(rows: DataFrame, shared: DataFrame, similar: Similar) -> DataFrame:
    """(place, id, line, tokens, n, marks, mixed, near) of the lines that post shared tokens.

    ``place`` is a number of its own, ``mixed`` tells that rows of one id have several sets there.
    """
    lines = shared.groupBy("id", "line").agg(F.max("near").alias("near"))
    by_doc = lines.groupBy("id").agg(F.collect_list(F.struct("line", "near")).alias("lines"))
    split = rows.join(by_doc, "id").withColumn("all", F.split("text", "\n", -1))
    chosen = split.select("id", F.explode(F.transform("lines", lambda i: F.struct(i["line"], i["near"], F.get("all", i["line"]).alias("words")))).alias("l"))
    chosen = chosen.where(_trimmed(F.col("l.words")) != "")
    full = chosen.select("id", "l.line", "l.near", tokens(F.col("l.words"), similar.width).alias("tokens"))
    # Rows that share an id: the place stands for its least token set.
    least = full.groupBy("id", "line").agg(F.max("near").alias("near"), F.min("tokens").alias("tokens"), F.max("tokens").alias("most"))
    more = {"n": F.size("tokens"), "marks": _marks(F.col("tokens")), "mixed": F.col("tokens") != F.col("most")}
    return least.withColumns(more).drop("most").withColumn("place", F.monotonically_increasing_id())


def _links(pairs: DataFrame, sets: DataFrame, similar: Similar) -> DataFrame:
    """(id, line, links): how many earlier classes a class is linked with, by its first place."""
    named = lambda s: sets.select(*[F.col(x).alias(f"{s}_{x}") for x in ("id", "line", "tokens")])
    both = pairs.join(named("c"), ["c_id", "c_line"]).join(named("d"), ["d_id", "d_line"])
    common = F.size(F.array_intersect("c_tokens", "d_tokens"))
    linked = both.where(common * 100 >= (F.size("c_tokens") + F.size("d_tokens") - common) * similar.percent)
    return linked.groupBy(F.col("c_id").alias("id"), F.col("c_line").alias("line")).agg(F.count(F.lit(1)).alias("links"))


def dedup_lines(docs: DataFrame, similar: Similar = Similar(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, n_removed, n_links, kept): every row with the lines that stay.

    ``n_links`` counts, for the lines that are the first of their class, the linked earlier classes.
    """
    classes = written(line_classes(docs, similar, key, text).drop("class"), "line-classes")
    shared = written(_shared(_posted(classes), similar), "line-shared")
    rows = docs.select(F.coalesce(F.col(key), F.lit(LAST_ID)).alias("id"), F.col(text).alias("text"))
    sets = written(_sets(rows, shared, similar), "line-sets")
    placed = written(_placed(shared, sets, similar), "line-placed")
    pairs = written(_near(placed, similar), "line-pairs")
    links = _links(pairs, sets, similar)
    judged = classes.select("id", "line").join(links, ["id", "line"], "left")
    by_doc = judged.groupBy("id").agg(
        F.collect_list(F.when(F.col("links").isNull(), F.col("line"))).alias("first_lines"), F.sum("links").alias("links")
    )
    none = F.array().cast("array<string>")
    split = rows.join(by_doc, "id", "left").withColumn("all", F.coalesce(F.split("text", "\n", -1), none))
    blank = F.filter(_upto(F.size("all") - 1), lambda i: _trimmed(F.get("all", i)) == "")
    firsts = F.filter(F.coalesce("first_lines", F.array().cast("array<int>")), lambda i: (i < F.size("all")) & (_trimmed(F.get("all", i)) != ""))
    stay = F.sort_array(F.concat(firsts, blank))
    kept = F.transform(stay, lambda i: F.get("all", i))
    return split.select(
        F.nullif(F.col("id"), F.lit(LAST_ID)).alias(key),
        F.size("all").cast("bigint").alias("n_lines"),
        (F.size("all") - F.size(kept)).cast("bigint").alias("n_removed"),
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.array_join(kept, "\n").alias("kept"),
    )


def line_sql(similar: Similar = Similar()) -> str:
    """The digest of ``op8`` in SQL: classes compared wherever they share a token."""
    lower = f"translate(l, '{UPPER}', '{LOWER}')"
    w = similar.width
    return f"""
with l as (select doc_id, unnest(string_split(text, chr(10))) as l, unnest(range(len(string_split(text, chr(10))))) as line
  from documents where text is not null),
t as (select doc_id, line, l, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') as w from l),
s as (select doc_id, line, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - {w - 1}, 1) + 1), lambda i: array_to_string(w[i : i + {w - 1}], ' ')))) as s
  from t where len(w) > 0),
p as (select doc_id, line, md5(array_to_string(s, chr(10))) as class, s from s),
f as (select class, min((doc_id, line)) as first, any_value(s) as s from p group by class),
x as (select class, first, len(s) as n, unnest(s) as token from f),
m as (select c.class as c, any_value(c.n) as cn, d.class as d, any_value(d.n) as dn, count(*) as both
  from x c join x d on c.token = d.token and d.first < c.first group by c.class, d.class),
k as (select c, count(*) as links from m where 100 * m.both >= {similar.percent} * (cn + dn - m.both) group by c),
j as (select t.doc_id, t.line, t.l, len(w) = 0 or ((t.doc_id, t.line) = first and links is null) as stays,
    case when (t.doc_id, t.line) = first then coalesce(links, 0) else 0 end as links
  from t left join p using (doc_id, line) left join f using (class) left join k on k.c = p.class)
select d.doc_id, count(j.line) as n_lines, count(case when not stays then 1 end) as n_removed, coalesce(sum(links), 0)::bigint as n_links,
  sha256(coalesce(string_agg(case when stays then l end, chr(10) order by line), '')) as kept_sha256
from documents d left join j using (doc_id) group by d.doc_id
"""
