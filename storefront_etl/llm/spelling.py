"""Spelling variants by composing finite-state machines (operator 11).

The vocabulary is counted over the whole corpus in Spark: runs of letters,
``A-Z`` lower-cased, some of them with a code point deleted by a checksum (so
that there are variants to find).  Two words are near if one code point is
inserted, deleted or replaced.

*Machines.*  The pairs are what the composition ``A . T . A`` accepts: A is
the minimised acyclic acceptor of words, T the transducer that copies its
input but for one edit.  Until the edit both copies of A read the same
symbols, so they are in one state; afterwards they read the same rest, so a
pair of states leads to the words' common rests (one state with itself: all
its rests).  An insertion into a run of equal letters is taken at its last
possible place, so that each pair is accepted once.

*Partitions.*  A pair's shorter word has L code points and the two agree on
their first ``lcp``.  All pairs with ``lo <= lcp < hi`` also agree on the last
``L - hi``, so a partition (L, lo, hi, first lo code points, last L - hi ones)
starts the composition at the states which that beginning leads to, over what
lies between.  Every word stands in the partitions ``[0, L/2)`` and
``[L/2, L + 1)`` of its own length and of the next smaller one.  A partition
of more than ``PARTITION_WORDS`` words is cut into its two halves, each with a
longer common part, and so on; one with ``hi = lo + 1`` holds only words that
differ in one or two letters.  So no task gets an unbounded partition, and no
pair is lost or met twice.  A task gives out counts and the best partner of
each word, no pairs.

*Roots.*  A form is ten times as frequent as its word, so chains of forms are
short; pointer doubling follows them in Spark.

Defined results: null and empty texts have no runs; a null doc_id counts as
empty text in the checksum; rows that repeat count again; words with equal n
take the smallest form by code points; an empty table gives no words; extra
columns are ignored; words may have any length.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storefront_etl.llm.common import quoted, stored, table
from storefront_etl.llm.merkle_manifest import SQL_CRC_TABLE, sql_crc32

# Fixed values.
LETTERS = "A-Za-zÀ-ÿ"
MIN_LETTERS = 7
MIN_COUNT = 2
STRUCK = 31
FORM_RATIO = 10

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Words that one composition runs over.
PARTITION_WORDS = 1000
KEY = ("length", "lo", "hi", "first", "last")


def lower_az(run: Column) -> Column:
    """A-Z lower-cased only; words of one byte a letter have no other capitals."""
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, UPPER.lower()))


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) over all texts: the runs of letters with their deletions, by number of occurrences."""
    # Deletion shortens: shorter runs can't become words.
    runs = docs.select(
        F.coalesce(quoted("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(quoted("text"), F.lit(f"[{LETTERS}]{{{min_letters},}}"), F.lit(0))).alias("run"),
    ).select("id", lower_az(F.col("run")).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = hashed.select(F.when(F.col("h") % STRUCK == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


# ---------------------------------------------------------------------------
# Machines
# ---------------------------------------------------------------------------
def common_length(a: str, b: str) -> int:
    k = 0
    for x, y in zip(a, b):  # noqa: B905  # up to the shorter one
        if x != y:
            break
        k += 1
    return k


class Acceptor:
    """The minimal acyclic automaton of sorted, distinct words; state 0 is the start."""

    def __init__(self, words: list[str]):
        self.out: list[dict[str, int]] = [{}]
        self.final = [False]
        # The shortest and longest rest that each state accepts.
        self.least, self.most = [0], [0]
        self._known: dict[tuple, int] = {}
        self._open: list[tuple[int, str, int]] = []
        before = ""
        for word in words:
            shared = common_length(before, word)
            self._close(shared)
            state = self._open[-1][2] if self._open else 0
            for letter in word[shared:]:
                self.out.append({})
                self.final.append(False)
                self.least.append(0)
                self.most.append(0)
                self.out[state][letter] = len(self.out) - 1
                self._open.append((state, letter, len(self.out) - 1))
                state = len(self.out) - 1
            self.final[state] = True
            before = word
        self._close(0)
        self._measure(0)

    def _measure(self, state: int) -> None:
        rests = self.out[state].values()
        self.least[state] = 0 if self.final[state] else min((self.least[s] for s in rests), default=0) + bool(rests)
        self.most[state] = max((self.most[s] + 1 for s in rests), default=0)

    def _close(self, depth: int) -> None:
        """States below ``depth`` on the last word's path get no more letters: equal ones become one."""
        while len(self._open) > depth:
            parent, letter, state = self._open.pop()
            self._measure(state)
            self.out[parent][letter] = self._known.setdefault((self.final[state], *self.out[state].items()), state)

    def common_rests(self, p: int, q: int, length: int, not_first: str = "") -> list[str]:
        """The rests of ``length`` letters that both states accept (without those that begin with ``not_first``)."""
        found, open_ = [], [(p, q, "")]
        while open_:
            p, q, rest = open_.pop()
            left = length - len(rest)
            if not (self.least[p] <= left <= self.most[p] and self.least[q] <= left <= self.most[q]):
                continue
            if not left:
                if self.final[p] and self.final[q]:
                    found.append(rest)
                continue
            other = self.out[q]
            for letter, state in self.out[p].items():
                if letter in other and (rest or letter != not_first):
                    open_.append((state, other[letter], rest + letter))
        return found


def one_edit_pairs(words: list[str], length: int, places: int) -> Iterator[tuple[str, str]]:
    """(a, b): a has ``length`` letters, b as many or one more, and one edit at a place before ``places`` makes a into b."""
    machine = Acceptor(words)
    before = None
    for word in words:
        # The beginnings of this word that no word before had.
        first = 0 if before is None else common_length(before, word) + 1
        state = 0
        for at in range(min(len(word) + 1, places)):
            if at >= first:
                beginning, letters = word[:at], list(machine.out[state].items())
                for k, (a, p) in enumerate(letters):
                    for b, q in letters[k + 1 :]:
                        for rest in machine.common_rests(p, q, length - at - 1):
                            yield beginning + a + rest, beginning + b + rest
                    for rest in machine.common_rests(state, p, length - at, not_first=a):
                        yield beginning + rest, beginning + a + rest
            if at < len(word):
                state = machine.out[state][word[at]]
        before = word


# ---------------------------------------------------------------------------
# Partitions
# ---------------------------------------------------------------------------
def first_partitions(words: DataFrame, min_letters: int) -> DataFrame:
    """(word, n, length, lo, hi): every word in both halves of its own length and of the next smaller one."""
    own = F.char_length("word")
    lengths = F.filter(F.array(own, own - 1), lambda x: x >= min_letters)
    placed = words.select("word", "n", F.explode(lengths).alias("length"))
    half, end = F.floor(F.col("length") / 2).cast("int"), F.col("length") + 1
    halves = F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), end.alias("hi")))
    return placed.select("word", "n", "length", F.inline(halves))


def with_key(rows: DataFrame) -> DataFrame:
    after = F.greatest(F.col("length") - F.col("hi"), F.lit(0))
    return rows.withColumns({
        "first": F.substring(F.col("word"), F.lit(1), F.col("lo")),
        "last": F.when(after > 0, F.substring(F.col("word"), F.char_length("word") - after + 1, after)).otherwise(F.lit("")),
    })


def composed(groups: DataFrame) -> DataFrame:
    """One row per partition (KEY, words) -> (word, near, form_n, form): its words' near words there, and the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows: list[tuple] = []
            for length, lo, hi, first, last, members in zip(*[part.column(c).to_pylist() for c in (*KEY, "members")], strict=True):
                start, end = len(first), len(last)
                n_of = {m["word"][start : len(m["word"]) - end]: m["n"] for m in members}
                near, best = defaultdict(int), {}
                for a, b in one_edit_pairs(sorted(n_of), length - start - end, hi - lo):
                    for one, other in ((a, b), (b, a)):
                        near[one] += 1
                        have, new = best.get(one), (-n_of[other], other)
                        if have is None or new < have:
                            best[one] = new
                rows += [(first + w + last, k, -best[w][0], first + best[w][1] + last) for w, k in near.items()]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["word", "near", "form_n", "form"]
            )

    return groups.select(*KEY, "members").mapInArrow(run, "word string, near long, form_n long, form string")


def near_words(words: DataFrame, min_letters: int = MIN_LETTERS, partition_words: int = PARTITION_WORDS) -> DataFrame:
    """(word, near, form_n, form) of the words that have a near word: how many, and the most frequent one."""
    rows, found = first_partitions(words, min_letters), None
    while True:
        keyed = with_key(rows)
        sizes = stored(keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "spelling-sizes")
        # Words alone in their partition go here.  Stored, since a large partition's rows need not come together.
        sized = stored(keyed.join(sizes, list(KEY)), "spelling-sized")
        whole = (F.col("size") <= partition_words) | (F.col("hi") - F.col("lo") == 1)
        groups = sized.where(whole).groupBy(*KEY).agg(F.collect_list(F.struct("word", "n")).alias("members"))
        part = stored(composed(groups), "spelling-near")
        found = part if found is None else found.unionByName(part)
        if sizes.where(~whole).isEmpty():
            break
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = F.array(F.struct("lo", middle.alias("hi")), F.struct(middle.alias("lo"), "hi"))
        rows = sized.where(~whole).select("word", "n", "length", F.inline(halves))
    best = found.groupBy("word").agg(F.sum("near").alias("near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
    return best.select("word", "near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, form) -> (word, root): the last form of each chain of at most ``longest`` steps."""
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, longest))))):
        now = stored(now, "spelling-roots")
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        now = now.join(ahead, now.root == ahead.at, "left").select("word", F.coalesce("further", "root").alias("root"))
    return now


def spelling_variants(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO, **options) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row per word of the vocabulary."""
    words = stored(vocabulary(docs, min_letters, min_count), "spelling-vocabulary")
    near = near_words(words, min_letters, **options)
    often = F.col("form_n") >= ratio * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word", F.when(often, F.col("form")).alias("form"), "n", F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.when(often, F.col("form_n")).alias("form_n"),
    )
    joined = stored(joined, "spelling-forms")
    # Each step multiplies n by `ratio`.
    most = joined.agg(F.max("n")).first()[0] or 1
    chains = roots(joined.where("form is not null"), math.ceil(math.log(max(2, most), max(2, ratio))) + 1)
    return joined.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


SQL = f"""
WITH RECURSIVE crc AS ({SQL_CRC_TABLE}),
runs AS (
  SELECT id, translate(run, '{UPPER}', '{UPPER.lower()}') AS run, count(*) AS times
  FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[{LETTERS}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, times, {sql_crc32("id || ':' || run")} AS h FROM runs, crc),
vocabulary AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
deleted AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM deleted a JOIN deleted b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM deleted a JOIN vocabulary b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM deleted a JOIN vocabulary b ON a.rest = b.word),
near AS (SELECT word, count(*) AS n_near FROM pairs GROUP BY word),
best AS (SELECT word, other, n AS other_n FROM pairs QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM vocabulary LEFT JOIN near USING (word) LEFT JOIN best USING (word)),
chains AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chains c JOIN forms f ON f.word = c.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chains c USING (word) JOIN forms l ON l.word = c.at AND l.form IS NULL"""
