"""Quality rules (operator 3), DataFrame functions only: weak supervision.

Eight rules look at counts over the whole text; each votes good (1), bad (-1)
or abstains (0).  Which votes come together how often is counted over all
documents - at most 3**8 patterns, whatever the size of the corpus - and
expectation-maximisation on these counts estimates, per rule and class, how
often the rule votes right, wrong or not at all, and the share of good
documents.  A document is kept if its posterior probability of being good is
at least one half, and if it passes the two base limits.

The counts of a document come from array functions over its words, n log n in
their number; no rows are exploded.  The estimation is one fold
over the pattern table; the posteriors go back to the documents as a broadcast
of that table, whose size 3**8 rows bounds.

Defined results: null texts count as texts without words; word-less texts fail
the base limits; repeated rows are judged alike and stay repeated; an empty
table gives no rows; other columns are kept by :func:`keep`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.llm.common import SPACE, session, words
from barsmith.session import materialize

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 50, 50  # base limits: words, percent of words in repeated windows
STEPS = 40  # of expectation-maximisation


def _bound(value: Column, body) -> Column:
    """body(value), with ``value`` evaluated once a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(w: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    def windows(x):
        each = F.transform(F.sequence(F.lit(1), F.size(x) - 2), lambda i: F.struct(
            F.xxhash64(F.get(x, i - 1), F.get(x, i), F.get(x, i + 1)).alias("h"), i.alias("p")))
        return _bound(F.sort_array(each), lambda s: covered(x, s))

    def same(x, a, b):
        words_equal = F.lit(True)
        for k in (-1, 0, 1):
            words_equal = words_equal & (F.get(x, a["p"] + k) == F.get(x, b["p"] + k))
        return F.coalesce((a["h"] == b["h"]) & words_equal, F.lit(False))

    def covered(x, s):
        twice = F.filter(s, lambda y, i: same(x, y, F.get(s, i - 1)) | same(x, y, F.get(s, i + 1)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda y: F.array(y["p"], y["p"] + 1, y["p"] + 2)))))

    return _bound(w, lambda x: F.when(F.size(x) < 3, 0).otherwise(windows(x)))


def counts(text: Column) -> Column:
    """Struct of the base counts and those the rules need, each over the whole
    text; words, lines and the text without white space are made once."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda s: F.regexp_replace(s, SPACE, "") != "")
    without = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))

    def fields(w, ln, dense):
        each = {
            "n_words": F.size(w),
            "word_chars": F.length(dense),
            "n_symbols": without(SYMBOLS),
            "n_lines": F.size(ln),
            "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)),
            "n_repeat_words": repeated_words(w),
            "n_other": F.length(F.regexp_replace(dense, r"\p{L}+", "")),
            "n_upper": without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
            "n_marks": without("!?"),
            "n_alone": F.size(F.filter(w, lambda x: ~x.rlike(r"\p{L}"))),
        }
        return F.struct(*[v.cast("long").alias(k) for k, v in each.items()])

    return _bound(words(t), lambda w: _bound(lines, lambda ln: _bound(F.regexp_replace(t, SPACE, ""), lambda dense: fields(w, ln, dense))))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("tinyint")


def rules(c) -> dict[str, Column]:
    """The votes, from a function that gives a count's column by name."""
    n = c("n_words")
    return {
        "word_length": _vote((c("word_chars") < 2 * n) | (c("word_chars") > 20 * n), (c("word_chars") >= 3 * n) & (c("word_chars") <= 12 * n)),
        "symbols": _vote(10 * c("n_symbols") > n, 50 * c("n_symbols") <= n),
        "dup_lines": _vote(2 * c("n_dup_lines") > c("n_lines"), (c("n_dup_lines") == 0) & (c("n_lines") > 2)),
        "repeats": _vote(10 * c("n_repeat_words") > 3 * n, 20 * c("n_repeat_words") <= n),
        "letters": _vote(10 * c("n_other") > c("word_chars"), 16 * c("n_other") <= c("word_chars")),
        "shouting": _vote(10 * c("n_upper") > 3 * c("word_chars"), 10 * c("n_upper") <= c("word_chars")),
        "marks": _vote(5 * c("n_marks") > n, 20 * c("n_marks") <= n),
        "alone": _vote(5 * c("n_alone") > n, 20 * c("n_alone") <= n),
    }


R = 8  # rules


def measured(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with the structs ``__count`` and ``__vote``."""
    out = docs.withColumn("__count", counts(F.col(text_col)))
    return out.withColumn("__vote", F.array(*rules(lambda k: F.col(f"__count.{k}")).values()))


def base_failed(c) -> Column:
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEAT * c("n_words"))


def estimate(votes: DataFrame) -> DataFrame:
    """(vote, posterior): one row for each pattern of ``votes`` (column vote).

    A state is an array: share of good documents, then per class (good, bad)
    the R chances of voting good and the R chances of voting bad.  Counts are
    smoothed by one vote of each kind."""
    patterns = votes.groupBy("vote").agg(F.count("*").cast("double").alias("n"))
    patterns = materialize(patterns, "vote-patterns")  # at most 3**R rows
    table = patterns.agg(F.sort_array(F.collect_list(F.struct("vote", "n"))).alias("pats"))

    def chance(state: str, at: int) -> str:
        p, m = f"{state}[{at} + r]", f"{state}[{at + R} + r]"
        return f"CASE x.vote[r] WHEN 1 THEN {p} WHEN -1 THEN {m} ELSE 1 - {p} - {m} END"

    def posterior(state: str) -> str:
        good, bad = (f"aggregate(sequence(0, {R - 1}), ln({share}), (acc, r) -> acc + ln({chance(state, at)}))"
                     for share, at in ((f"{state}[0]", 1), (f"1 - {state}[0]", 1 + 2 * R)))
        return f"1 / (1 + exp(least({bad} - {good}, 500D)))"

    def total(weight: str, when: str = "true") -> str:
        return f"aggregate(w, 0D, (acc, x) -> acc + IF({when}, x.n * {weight}, 0D))"

    def maximise(weighted: str) -> str:
        """New state from patterns that carry their posterior q."""
        chances = []
        for q in ("x.q", "(1 - x.q)"):
            for v in (1, -1):
                chances += [f"({total(q, f'x.vote[{r}] = {v}')} + 1) / ({total(q)} + 3)" for r in range(R)]
        share = f"({total('x.q')} + 1) / ({total('1D')} + 2)"
        return f"transform(array({weighted}), w -> array({', '.join([share, *chances])}))[0]"

    def weighted(q: str) -> str:
        return f"transform(pats, x -> named_struct('vote', x.vote, 'n', x.n, 'q', {q}))"

    # to begin with, a bad vote outweighs three good ones
    votes_of = lambda v: f"size(filter(x.vote, y -> y = {v}))"
    begin = f"1 / (1 + exp(least(4D * {votes_of(-1)} - {votes_of(1)}, 500D)))"
    fold = f"aggregate(sequence(1, {STEPS}), {maximise(weighted(begin))}, (state, i) -> {maximise(weighted(posterior('state')))})"
    state = table.withColumn("state", F.expr(fold))
    return state.select(F.expr(f"explode({weighted(posterior('state'))})").alias("p")).select("p.vote", F.col("p.q").alias("posterior"))


def _judged(rows: DataFrame, posteriors: DataFrame) -> DataFrame:
    """``rows`` (with __count, __vote) with ``__posterior`` and ``__kept``."""
    p = posteriors.select(F.col("vote").alias("__vote"), F.col("posterior").alias("__posterior"))
    failed = base_failed(lambda k: F.col(f"__count.{k}"))
    return (rows.join(F.broadcast(p), "__vote", "left")  # at most 3**R rows
            .withColumn("__kept", ~failed & (F.coalesce("__posterior", F.lit(0.0)) >= 0.5)))


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts, the votes' posterior, base_failed, kept."""
    session(docs.sparkSession)
    rows = measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    rows = materialize(rows.select("doc_id", "__count", "__vote"), "rule-votes")
    out = _judged(rows, materialize(estimate(rows.select(F.col("__vote").alias("vote"))), "posteriors"))
    return out.select("doc_id", "__count.*", base_failed(lambda k: F.col(f"__count.{k}")).alias("base_failed"),
                      F.col("__kept").alias("kept"), F.col("__posterior").alias("posterior"))


def keep(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, all columns.  The texts
    are measured twice rather than shuffled or written with their votes."""
    session(docs.sparkSession)
    votes = measured(docs.select(F.col(text_col).alias("text")), "text").select(F.col("__vote").alias("vote"))
    posteriors = materialize(estimate(votes), "posteriors")
    return _judged(measured(docs, text_col), posteriors).filter("__kept").select(*docs.columns)
