"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

For each text: counts of words, characters, symbols, repeated lines and repeated words, then
ratios of length, symbols, stop words and lines, each held against its bounds. No user function
runs; every value is computed within its row, so that nothing is shuffled.

Nulls and empty texts have no words: all counts are 0 and base_failed is true. Ratios over zero
words count as 0. Repeated rows are judged alike. Columns of the input are not carried, but for
doc_id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
# Frequent short words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with be by this from at or an which not",
    "de la le et les des en un une du dans pour que qui sur pas au par est",
    "der die und das in den von zu mit auf für ist im dem nicht ein eine sich des auch als",
    "el la los las de y en que un una con por para se su del al lo es",
)


@dataclass(frozen=True)
class Rule:
    """A named SQL expression over the counts, and the bounds that it has to keep."""

    name: str
    value: str
    low: float | None = None
    high: float | None = None


#: The threshold table.
RULES = (
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 2.0, 15.0),
    Rule("symbols_per_word", "n_symbols / greatest(n_words, 1)", high=0.3),
    Rule("exclamations_per_word", "n_exclamations / greatest(n_words, 1)", high=0.3),
    Rule("stop_words_per_word", "n_stop_words / greatest(n_words, 1)", low=0.02),
    Rule("uppercase_per_letter", "n_upper / greatest(n_letters, 1)", high=0.5),
    Rule("repeated_lines_per_line", "n_dup_lines / greatest(n_lines, 1)", high=0.5),
)


def _literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def repeated_words(words: str) -> str:
    """SQL: how many of words (the name of an array) lie in three-word windows that occur twice or more.

    The windows' hashes are sorted with their places; equal neighbours repeat. Of the sorted
    places p of repeats each adds min(3, p - the place before) words.
    """
    return (
        f"CASE WHEN size({words}) < 4 THEN 0L ELSE "
        f"transform(array(sort_array(transform(slice({words}, 1, size({words}) - 2), (x, i) -> "
        f"named_struct('h', xxhash64(x, {words}[i + 1], {words}[i + 2]), 'i', i)))), s -> "
        "transform(array(sort_array(transform(filter(s, (x, i) -> x.h = get(s, i - 1).h OR x.h = get(s, i + 1).h), x -> x.i))), p -> "
        "aggregate(transform(p, (x, i) -> IF(i = 0, 3L, least(3L, CAST(x - p[i - 1] AS BIGINT)))), 0L, (a, x) -> a + x)"
        ")[0])[0] END"
    )


def measures(text: str = "text") -> list[str]:
    """SQL of structs that hold the counts. An array that several counts need is bound once, as the one item of an array."""
    t = f"coalesce({text}, '')"
    gone = lambda pattern: f"CAST(length({t}) - length(regexp_replace({t}, '{pattern}', '')) AS BIGINT)"
    stops = ", ".join(_literal(w) for w in sorted({w for ws in STOP_WORDS for w in ws.split()}))
    of_words = (
        f"transform(array(regexp_extract_all({t}, {_literal(WORD)}, 0)), w -> named_struct('n_words', CAST(size(w) AS BIGINT), "
        f"'word_chars', CAST(length(array_join(w, '')) AS BIGINT), 'n_repeat_words', {repeated_words('w')}))[0]"
    )
    of_lines = (
        f"transform(array(filter(split({t}, '\n'), l -> l RLIKE {_literal(WORD)})), l -> "
        "named_struct('n_lines', CAST(size(l) AS BIGINT), 'n_dup_lines', CAST(size(l) - size(array_distinct(l)) AS BIGINT)))[0]"
    )
    of_chars = (
        f"named_struct('n_symbols', {gone(f'[{SYMBOLS}]+')}, 'n_exclamations', {gone('!+')}, 'n_upper', {gone(chr(92) * 2 + 'p{Lu}+')}, 'n_letters', {gone(chr(92) * 2 + 'p{L}+')}, "
        f"'n_stop_words', CAST(size(filter(split(lower({t}), '[^\\\\p{{L}}]+'), w -> w IN ({stops}))) AS BIGINT))"
    )
    return [of_words, of_lines, of_chars]


def _broken(r: Rule) -> str:
    tests = [f"{r.value} < {r.low}"] * (r.low is not None) + [f"{r.value} > {r.high}"] * (r.high is not None)
    return " OR ".join(tests) or "false"


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """doc_id, the counts, base_failed, kept, and the names of the rules that failed."""
    counted = docs.select("doc_id", *(F.expr(e).alias(f"m{i}") for i, e in enumerate(measures()))).select("doc_id", "m0.*", "m1.*", "m2.*")
    failed = "filter(array(" + ", ".join(f"IF({_broken(r)}, '{r.name}', NULL)" for r in rules) + "), x -> x IS NOT NULL)"
    base = f"n_words < {min_words} OR 100 * n_repeat_words > {most_repeated} * n_words"
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.expr(base).alias("base_failed"),
        F.expr(f"NOT ({base}) AND size({failed}) = 0").alias("kept"),
        F.expr(f"array_join({failed}, ',')").alias("failed_rules"),
    )
