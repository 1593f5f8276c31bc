"""License scan: ordered signature rules, gated by keywords, with suppression of what stronger detections contain.

A text is split into words once. Where a word is a rule's keyword, the words around it (``REACH`` on either side, A-Z
lower-cased) make a window, and the rules of that keyword look at the window: first for a second word that they need, then
with their regular expression, in which the keyword has to stand at that very place. So every occurrence of a keyword
answers for itself, and the work follows the number of keywords, not the number of rules times the length of the text.

A detection is an interval of words. It is suppressed when its interval lies within that of another one with a higher
priority, of an equal priority but more words, or equal in both and earlier in the order. As rules reach no further than ``REACH``
words from their keyword, the others can only stem from the ``2 * REACH`` keywords before or after: the comparison stays within that
many neighbours, however often a text repeats a phrase. The base phrases' labels stay in any case.

Everything is one expression over a row, without shuffle and without Python.

Defined results: null and empty texts have no words, no labels (empty strings) and score 0; the score is the largest weight among the
detections that are left; places are counted in words from 0; repeated rows count each; an empty table gives none. Other columns are passed on;
columns named as an output are replaced.
"""
from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, functions as F

from .license_rules import MARK, REACH, Rule, rules

#: Runs of a-z, 0-9 and everything outside ASCII, once A-Z is lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OUT = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _matches(by_keyword: dict[str, list[Rule]]) -> str:
    """SQL of what the rules of the window ``w``'s keyword match of it: their numbers and the matches, null where nothing."""

    def tried(rule: Rule) -> str:
        look = f"regexp_extract(w.text, '{rule.pattern}', 0)"
        return f"struct({rule.order} AS order, {f"CASE WHEN contains(w.text, '{rule.need}') THEN {look} END" if rule.need else look} AS match)"

    cases = " ".join(f"WHEN '{k}' THEN array({', '.join(map(tried, own))})" for k, own in sorted(by_keyword.items()))
    return f"filter(CASE w.word {cases} ELSE array(struct(0 AS order, '' AS match)) END, m -> m.match <> '')"


def _detection(window: Column, match: Column, meta: Column) -> Column:
    """The interval of a match: the marker parts the words before the keyword from it and those after."""
    before = _spaces(F.substring_index(match["match"], MARK, 1)) - 1
    rule, start = F.element_at(meta, match["order"] + 1), window["place"] - before
    return F.struct(
        start.cast("int").alias("start"), (start + _spaces(match["match"]) - 1).cast("int").alias("stop"), rule["priority"].alias("priority"),
        match["order"].alias("order"), rule["label"].alias("label"), rule["weight"].alias("weight"), rule["base"].alias("base"),
    )


def _outranks(one: Column, other: Column) -> Column:
    """Whether ``one`` suppresses ``other``."""
    longer = (one["stop"] - one["start"]) - (other["stop"] - other["start"])
    return (one["start"] <= other["start"]) & (one["stop"] >= other["stop"]) & (
        (one["priority"] > other["priority"]) | ((one["priority"] == other["priority"]) & ((longer > 0) | ((longer == 0) & (one["order"] < other["order"]))))
    )


def _left(found: Column) -> Column:
    """Of the detections of every keyword in turn, those that no neighbour suppresses."""

    def near(i: Column) -> Column:
        return F.flatten(F.slice(found, F.greatest(i + 1 - 2 * REACH, F.lit(1)), F.lit(4 * REACH + 1)))

    return F.flatten(F.transform(found, lambda own, i: F.when(F.size(own) == 0, own).otherwise(F.filter(own, lambda d: ~F.exists(near(i), lambda o: _outranks(o, d))))))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, text: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """The documents' columns without ``text``, word and base counts, labels, score and the detections that are left."""
    signatures = rules() if signatures is None else signatures
    by_keyword: dict[str, list[Rule]] = defaultdict(list)
    for rule in signatures:
        for keyword in rule.keywords:
            by_keyword[keyword].append(rule)
    meta = F.expr(f"array({', '.join(f"struct({r.priority} AS priority, '{r.label}' AS label, {r.weight}D AS weight, {r.base} AS base)" for r in signatures)})")
    kept = [c for c in docs.columns if c != text and c not in OUT]
    # lower() knows more letters than A-Z, so it lets through all that translate() would; the window's own word decides
    gated = [F.filter(F.transform("_words", lambda w, i: F.when(F.lower(w).isin(*sorted(by_keyword)), i)), lambda i: i.isNotNull()).alias("_places")]

    def window(i: Column) -> Column:
        before = F.slice("_words", F.greatest(i + 1 - REACH, F.lit(1)), F.least(i, F.lit(REACH)))
        after = F.slice("_words", i + 1, F.lit(REACH + 1))
        text = F.concat(F.lit(" "), F.concat_ws(" ", before), F.when(i > 0, " ").otherwise(""), F.lit(MARK), F.concat_ws(" ", after), F.lit(" "))
        return F.struct(i.alias("place"), F.translate(F.element_at("_words", i + 1), UPPER, LOWER).alias("word"), F.translate(text, UPPER, LOWER).alias("text"))

    words = docs.select(*[F.col(f"`{c}`") for c in kept], F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)).alias("_words"))
    places = words.select(*[F.col(f"`{c}`") for c in kept], F.size("_words").cast("long").alias("n_words"), "_words", *gated)
    windows = places.select(*[F.col(f"`{c}`") for c in kept], "n_words", F.transform("_places", window).alias("_windows"))
    tried = windows.withColumn("_tried", F.expr(f"transform(_windows, w -> struct(w.place, {_matches(by_keyword)} AS matches))"))
    found = tried.withColumn("_found", F.transform("_tried", lambda w: F.transform(w["matches"], lambda m: _detection(w, m, meta))))
    left = found.withColumns({"_base": F.filter(F.flatten("_found"), lambda d: d["base"]), "_left": _left(F.col("_found"))})
    starts, base_labels = F.transform("_base", lambda d: d["start"].cast("long")), F.transform("_base", lambda d: d["label"])
    return left.select(
        *[F.col(f"`{c}`") for c in kept], "n_words", F.size("_base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"), _joined(base_labels).alias("base_labels"),
        _joined(F.concat(base_labels, F.transform("_left", lambda d: d["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("_left", lambda d: d["weight"])), F.lit(0.0)).alias("score"),
        F.transform("_left", lambda d: F.struct(d["start"], d["stop"], d["label"], d["weight"])).alias("detections"),
    )


def _sql_rows(signatures: list[Rule]) -> str:
    quoted = [
        f"({r.order}, '{k}', '{r.need}', {r.priority}, '{r.label}', {r.weight!r}, {str(r.base).lower()}, '{r.pattern.replace(MARK, '#')}')"
        for r in signatures for k in r.keywords
    ]
    return ", ".join(quoted)


#: The same scan as joins over all words of all texts; ``#`` (no word has it) marks the keyword.
SQL = rf"""
WITH rules(ord, keyword, need, priority, label, weight, base, pattern) AS (VALUES {_sql_rows(rules())}),
texts AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i, w FROM texts),
windows AS (
  SELECT r, i, word, concat(' ', array_to_string(w[greatest(i - {REACH}, 1):i - 1], ' '), CASE WHEN i > 1 THEN ' ' ELSE '' END, '#', array_to_string(w[i:i + {REACH}], ' '), ' ') AS near
  FROM words WHERE word IN (SELECT keyword FROM rules)),
tried AS (SELECT r, i, rules.*, regexp_extract(near, pattern) AS m FROM windows JOIN rules ON keyword = word),
placed AS (
  SELECT DISTINCT r, ord, priority, label, weight, base, i - 1 - (length(split_part(m, '#', 1)) - length(replace(split_part(m, '#', 1), ' ', '')) - 1) AS a,
         length(m) - length(replace(m, ' ', '')) - 1 AS n FROM tried WHERE m <> ''),
kept AS (
  SELECT * FROM placed d WHERE NOT EXISTS (
    SELECT 1 FROM placed o WHERE o.r = d.r AND o.a <= d.a AND o.a + o.n >= d.a + d.n
      AND (o.priority > d.priority OR (o.priority = d.priority AND (o.n > d.n OR (o.n = d.n AND o.ord < d.ord)))))),
base AS (SELECT r, count(*) AS n_base, min(a) AS first_word, max(a) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM placed WHERE base GROUP BY r),
strong AS (SELECT r, max(weight) AS score FROM kept GROUP BY r),
named AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM kept UNION ALL SELECT r, label FROM placed WHERE base) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM texts LEFT JOIN base USING (r) LEFT JOIN strong USING (r) LEFT JOIN named USING (r)"""
