"""Operator 7: quality rules, compiled from a threshold table into one Spark projection.

Only built-in functions: no Python, no shuffle, one scan. Texts are split once
into words and lines; counts come from those arrays. Windows of eight words are
compared by 64-bit hashes; a text whose hashes are all distinct has no repeat,
and only the others sort them to find which words the repeats cover.

A rule bounds a ratio of two counts in thousandths, so verdicts are integer
comparisons. A rule whose denominator is 0 holds.

Defined results: a null, empty or blank text has no words and all counts 0, so
it fails the base rule; rows with the same id are judged each; whole texts of
any length are counted. Only the two named columns are read.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: the space and U+0009 to U+000D.
SPACE = " \t\n\x0b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
#: Taken off the ends of a word before it is looked up among the stop words.
EDGES = ".,;:!?\"'()"
WINDOW = 8

#: Common function words of the corpus's languages.
STOP_WORDS = {
    "en": "the of and to in is was for that with on by this from are be it as at or an a not but which you have has had were they their",
    "de": "der die das und in zu den mit von für auf ist im ein eine nicht auch es an dem des sich als bei nach wie aus er sie wird",
    "fr": "le la les de des du un une et en que qui dans pour est sur pas au aux ses plus par avec ce il elle ne se sont",
    "es": "el la los las de del un una y en que por con para como se su al lo es no más pero sus le ha o este",
}


class Rule(NamedTuple):
    """``low`` and ``high`` bound 1000 * part / whole, both included."""

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None


#: The method's rules. They leave room around what ordinary prose shows.
RULES = (
    Rule("characters per word", "word_chars", "n_words", 2_000, 15_000),
    Rule("symbols per character", "n_symbols", "word_chars", None, 20),
    Rule("exclamation and question marks per word", "n_marks", "n_words", None, 300),
    Rule("stop words per word", "n_stop_words", "n_words", 20, None),
    Rule("repeated lines per line", "n_dup_lines", "n_lines", None, 400),
)


def holds(rule: Rule) -> Column:
    scaled, whole = F.col(rule.part) * 1000, F.col(rule.whole)
    sides = [scaled >= whole * rule.low] if rule.low is not None else []
    sides += [scaled <= whole * rule.high] if rule.high is not None else []
    return (whole == 0) | reduce(lambda a, b: a & b, sides)


def _characters(text: Column, of: str) -> Column:
    return F.length(text) - F.length(F.translate(text, of, ""))


def measured(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id and the counts) of every row; the columns ``keep`` of ``docs`` as a struct ``own``, if any."""
    own = [F.struct(*[docs[c] for c in keep]).alias("own")] if keep else []
    carried = ["own"] if keep else []
    text = F.coalesce(docs[text_col], F.lit(""))
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    split = docs.select(
        docs[doc_col].cast("long").alias("doc_id"),
        *own,
        text.alias("t"),
        F.filter(F.split(text, SPLIT), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, SPACE, "")) > 0).alias("lines"),
    )
    n = F.size("words")
    hashed = split.select(
        "doc_id",
        *carried,
        n.cast("long").alias("n_words"),
        F.length(F.translate("t", SPACE, "")).cast("long").alias("word_chars"),
        _characters(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        _characters(F.col("t"), MARKS).cast("long").alias("n_marks"),
        F.size(F.filter("words", lambda w: F.btrim(F.lower(w), F.lit(EDGES)).isin(stop))).cast("long").alias("n_stop_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))).alias("hashes"),
    )
    repeats = F.size("hashes") > F.size(F.array_distinct("hashes"))
    ranked = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = hashed.select("*", F.when(repeats, ranked).alias("ranked")).drop("hashes")

    def repeated(_, k):
        return F.coalesce(F.get("ranked", k)["h"] == F.get("ranked", k - 1)["h"], F.lit(False)) | F.coalesce(F.get("ranked", k)["h"] == F.get("ranked", k + 1)["h"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("ranked", repeated), lambda r: r["i"]))
    placed = sorted_.select("*", starts.alias("starts")).drop("ranked")
    # Each repeated window adds its words up to the start of the next one.
    covered = F.transform("starts", lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - s, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return placed.select("*", F.coalesce(total, F.lit(0).cast("long")).alias("n_repeat_words")).drop("starts")


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 20, max_repeat_percent: int = 30, doc_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The counts of every row, ``base_failed`` and ``kept``; see :func:`measured` for ``keep``."""
    counts = measured(docs, doc_col, text_col, keep)
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    verdict = reduce(lambda a, b: a & b, map(holds, rules), F.lit(True))
    return counts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_stop_words", "n_lines", base.alias("base_failed"), (~base & verdict).alias("kept"), *(["own"] if keep else [])
    )


def passing(docs: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The ``columns`` of the rows that are kept.

    The row number keeps the filter above the counts: pushed below, the
    predicate would repeat every expression that it is made of.
    """
    judged = judge(docs, keep=columns).select("kept", "own", F.monotonically_increasing_id().alias("row"))
    return judged.where("kept and row >= 0").select("own.*")


def _sql() -> str:
    """DuckDB SQL for :func:`judge` over ``documents``, by joins over unnested words instead of arrays."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for words in STOP_WORDS.values() for w in words.split()}))
    rules = []
    for r in RULES:
        sides = [f"{r.part} * 1000 >= {r.whole} * {r.low}"] if r.low is not None else []
        sides += [f"{r.part} * 1000 <= {r.whole} * {r.high}"] if r.high is not None else []
        rules.append(f"({r.whole} = 0 or ({' and '.join(sides)}))")
    edges = EDGES.replace("'", "''")
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, unnest(ws) as w, generate_subscripts(ws, 1) as i from (
  select r, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from d)),
win as (select r, i, string_agg(w, ' ') over (partition by r order by i rows between current row and {WINDOW - 1} following) as s,
  count(*) over (partition by r order by i rows between current row and {WINDOW - 1} following) as k from w),
rep as (select r, i from (select r, i, count(*) over (partition by r, s) as c from win where k = {WINDOW}) where c > 1),
cov as (select r, count(distinct p) as n from (select r, unnest(range(i, i + {WINDOW})) as p from rep) group by r),
per as (select r, count(*) as n_words, sum(length(w)) as word_chars,
  count(*) filter (where trim(lower(w), '{edges}') in ({stop})) as n_stop from w group by r),
ln as (select r, count(*) as n_lines, count(*) - count(distinct l) as n_dup from (
  select r, unnest(string_split(t, chr(10))) as l from d) where regexp_matches(l, '[^\\x20\\x09-\\x0D]') group by r),
m as (select d.doc_id, cast(coalesce(n_words, 0) as bigint) as n_words, cast(coalesce(word_chars, 0) as bigint) as word_chars,
  cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
  cast(coalesce(n_dup, 0) as bigint) as n_dup_lines, cast(coalesce(cov.n, 0) as bigint) as n_repeat_words,
  cast(length(regexp_replace(t, '[^!?]', '', 'g')) as bigint) as n_marks, cast(coalesce(n_stop, 0) as bigint) as n_stop_words,
  cast(coalesce(n_lines, 0) as bigint) as n_lines
  from d left join per using (r) left join ln using (r) left join cov using (r)),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from m)
select *, not base_failed and {' and '.join(rules)} as kept from b"""


SQL = _sql()
