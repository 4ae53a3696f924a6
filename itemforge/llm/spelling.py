"""Spelling variants: words at one error from each other, found by forward and backward minimal acyclic automata.

Of two words at one error, the shorter having L code points, one half stands unchanged in both: the error lies in the other. So words
meet by their length and one half (`keyed`), and a task builds the minimal acyclic automaton of its words, of the words as they are for
errors in the second half and of the reversed ones for the first. A word matches its exact half, then completes with one error:
another letter than its own, or its own letter left out. States hold numbers of words, so that a path gives the word's number, a perfect
hash, which the counts are looked up by. A position is tried in one half only, and of a run of equal letters only the first may be left out, so no pair is
found twice.

A half that too many words share is cut again: these words meet by all but a quarter, an eighth and so on, until few meet
or the part left open is one letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itemforge.llm.common import batch, materialise, table, text_bytes

RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
MODULUS = 31
LEAST_LENGTH, LEAST_N = 7, 2
#: A form occurs so many times as often as the word.
TIMES = 10
#: Words that a task counts before it hands them on.
HELD = 400_000
#: Rows with one key that meet without being cut again, and rows a task, about.
HOT, TASK_ROWS = 20_000, 100_000


def variant(run: bytes, begun: int) -> bytes:
    """A run as it counts: where the checksum (that of the document's number goes on) is a multiple of MODULUS, without one code point."""
    h = zlib.crc32(run, begun)
    if h % MODULUS:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): the words of at least LEAST_LENGTH code points that occur LEAST_N times or more in all whole texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def told() -> pa.RecordBatch:
            return batch({"word": pa.array(list(held), pa.binary()).cast(pa.string()), "n": list(held.values())}, schema)

        for b in batches:
            for doc, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                begun = zlib.crc32(b":" if doc is None else b"%d:" % doc)
                for run, n in Counter(RUN.findall(body.as_py().lower())).items():
                    word = variant(run, begun)
                    if len(word) >= LEAST_LENGTH and len(word) - word.count(b"\xc3") >= LEAST_LENGTH:
                        held[word] += n
                if len(held) >= HELD:
                    yield told()
                    held.clear()
        if held:
            yield told()

    parts = docs.select(F.col(key).cast("long"), text_bytes(text)).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_N)


# Automata ------------------------------------------------------------------------------------------------------------


class State:
    """arcs: letter to (state, number of words before those by this arc); n: words from here on; final: whether one ends here."""

    __slots__ = ("arcs", "n", "final")

    def __init__(self, arcs: dict[str, tuple[State, int]], n: int, final: bool) -> None:
        self.arcs, self.n, self.final = arcs, n, final


def automaton(words: list[str]) -> State:
    """The minimal acyclic automaton of different words in ascending order; equal states are one. A word's number is its place in the list."""
    known: dict[tuple, State] = {}
    path: list[tuple[str, list[tuple[str, State]]]] = [("", [])]
    finals = [False]

    def frozen(arcs: list[tuple[str, State]], final: bool) -> State:
        name = (final, *((letter, id(state)) for letter, state in arcs))
        if name not in known:
            n, by = int(final), {}
            for letter, state in arcs:
                by[letter] = (state, n)
                n += state.n
            known[name] = State(by, n, final)
        return known[name]

    def close(depth: int) -> None:
        while len(path) > depth:
            letter, arcs = path.pop()
            path[-1][1].append((letter, frozen(arcs, finals.pop())))

    last = ""
    for word in words:
        common = next((k for k, (a, b) in enumerate(zip(last, word, strict=False)) if a != b), min(len(last), len(word)))
        close(common + 1)
        for letter in word[common:]:
            path.append((letter, []))
            finals.append(False)
        finals[-1], last = True, word
    close(1)
    return frozen(path[0][1], finals[0])


def _end(state: State, number: int, rest: str) -> int:
    """The number of the word that `rest` completes from a state, or -1."""
    for letter in rest:
        arc = state.arcs.get(letter)
        if arc is None:
            return -1
        state, before = arc
        number += before
    return number if state.final else -1


def replaced(root: State, word: str, low: int, high: int) -> Iterator[int]:
    """Numbers of the words that differ from this one in exactly one letter, at a position from low until before high."""
    state, number = root, 0
    for at, letter in enumerate(word[:high]):
        if at >= low:
            for other, (following, before) in state.arcs.items():
                if other != letter and (found := _end(following, number + before, word[at + 1 :])) >= 0:
                    yield found
        arc = state.arcs.get(letter)
        if arc is None:
            return
        state, number = arc[0], number + arc[1]


def shortened(root: State, word: str, low: int, high: int, last_of_run: bool = False) -> Iterator[int]:
    """Numbers of the words that this one becomes without one letter, at a position from low until before high; of a run of equal letters without its first (or last) one."""
    state, number = root, 0
    for at, letter in enumerate(word[:high]):
        beside = at + 1 if last_of_run else at - 1
        if at >= low and not (0 <= beside < len(word) and word[beside] == letter) and (found := _end(state, number, word[at + 1 :])) >= 0:
            yield found
        arc = state.arcs.get(letter)
        if arc is None:
            return
        state, number = arc[0], number + arc[1]


class _Side:
    """The words of a task in one direction, with their counts, the number of near words found and the best of them."""

    def __init__(self, rows: dict[str, int], backward: bool) -> None:
        self.words = sorted(rows)
        self.n = [rows[w] for w in self.words]
        self.root = automaton(self.words)
        self.backward = backward

    def near(self, word: str, length: int, low: int, high: int) -> Iterator[int]:
        """Words of `length` letters at one error from word, the error's position in reading order between low and high."""
        if self.backward:
            low, high = len(word) - high, len(word) - low
        # Reversed, the first letter of a run is its last.
        return replaced(self.root, word, low, high) if len(word) == length else shortened(self.root, word, low, high, self.backward)


def _met(rows: list[tuple], found: dict[str, list]) -> None:
    """Enter each word's near words among the rows (length, level, segment, word, n) of a task in found: word to [number, least (-n, word)]."""

    def enter(word: str, other: str, n: int) -> None:
        known = found.setdefault(word, [0, (1, "")])
        known[0] += 1
        known[1] = min(known[1], (-n, other))

    sides: tuple[dict[str, int], dict[str, int]] = ({}, {})
    asked: tuple[list, list] = ([], [])
    for length, level, segment, word, n in rows:
        low, high = (length * (segment + k) >> level for k in (0, 1))
        backward = low < length - high
        turned = word[::-1] if backward else word
        if len(word) == length:
            sides[backward][turned] = n
        elif segment + 1 == 1 << level:
            high += 1
        asked[backward].append((turned, n, length, low, high))
    for backward in (False, True):
        side = _Side(sides[backward], backward)
        back = (lambda w: w[::-1]) if backward else (lambda w: w)
        for word, n, length, low, high in asked[backward]:
            for k in side.near(word, length, low, high):
                enter(back(word), back(side.words[k]), side.n[k])
                if len(word) > length:
                    enter(back(side.words[k]), back(word), n)


# Spark ---------------------------------------------------------------------------------------------------------------


def _key(rows: DataFrame) -> DataFrame:
    """rows (word, n, length, level, segment) with outside: what of the word stands before and after the segment."""
    bound = lambda k: f"cast(shiftright(length * (segment + {k}), level) as int)"
    return rows.withColumn("outside", F.expr(f"concat(substring(word, 1, {bound(0)}), ' ', substring(word, {bound(1)} + 1 + char_length(word) - length))"))


def keyed(words: DataFrame) -> DataFrame:
    """(word, n, length, level, segment, outside): a row for each half of each word, among words of its own length and among those one shorter."""
    size = F.char_length("word").cast("long")
    lengths = words.select("word", "n", F.explode(F.when(size > LEAST_LENGTH, F.array(size, size - 1)).otherwise(F.array(size))).alias("length"))
    return _key(lengths.select("word", "n", "length", F.lit(1).alias("level"), F.explode(F.array(*(F.lit(k).cast("long") for k in (0, 1)))).alias("segment")))


def _spread(rows: DataFrame, hot: int) -> DataFrame:
    """rows with those of keys that more than `hot` rows share cut again, until none is left."""
    by, cool = ["length", "level", "segment", "outside"], []
    while True:
        many = materialise(rows.groupBy(*by).agg(F.count("*").alias("rows")).filter((F.col("rows") > hot) & F.expr("shiftright(length, level) > 0")).select(*by), "hot") if hot else None
        if many is None or many.isEmpty():
            return _union([*cool, rows])
        cool.append(rows.join(many, by, "left_anti").select(rows.columns))
        again = rows.join(many, by, "left_semi").select("word", "n", "length", (F.col("level") + 1).alias("level"), F.explode(F.array(F.col("segment") * 2, F.col("segment") * 2 + 1)).alias("segment"))
        rows = materialise(_key(again), "keyed")


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def near_words(words: DataFrame, hot: int = HOT, task_rows: int = TASK_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words: their number, and that of largest n, the smallest in code-point order of those."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    rows = _spread(materialise(keyed(words), "keyed"), hot)
    parts = max(1, -(-rows.count() // task_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, found = [], {}
        for b in batches:
            every += zip(*(b.column(k).to_pylist() for k in range(5)), strict=True)
        _met(every, found)
        if found:
            yield batch({"word": list(found), "n_near": [x[0] for x in found.values()], "best_n": [-x[1][0] for x in found.values()], "best": [x[1][1] for x in found.values()]}, schema)

    dealt = rows.repartition(parts, "length", "level", "segment", "outside").select("length", "level", "segment", "word", "n")
    told = dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return told.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("first")).select("word", "n_near", (-F.col("first.less")).alias("best_n"), "first.best")


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for the words of links (word, form): what their chain of forms ends in. Each round halves the chains, whose lengths are logarithms of counts."""
    now = materialise(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = materialise(now.join(ahead, now["root"] == ahead["at"], "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variant_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", hot: int = HOT, task_rows: int = TASK_ROWS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word: its near word of largest n where that is TIMES as frequent, and where such forms lead.

    Null and empty texts have no words; a null key counts as no digits before the colon. Repeated rows count as often as they occur. Texts and words are
    taken whole, whatever their length. Columns other than the text and the key are not read.
    """
    words = materialise(word_counts(docs, text, key), "words")
    near = near_words(words, hot, task_rows)
    is_form = F.col("best_n") >= F.col("n") * TIMES
    named = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    named = materialise(named, "forms")
    found = roots(named.filter("form IS NOT NULL").select("word", "form"))
    return named.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form, root and counts."""
    return variant_groups(table(spark, sf_dir, "documents"))
