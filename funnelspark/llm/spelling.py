"""Spelling variants by search schemes over a bidirectional FM-index of the delimited vocabulary.

1. *Vocabulary.* Runs of letters of whole texts, lower-cased in A-Z, are counted by Spark; ``misspelled`` may alter a run before it is counted.
2. *Shards.* Of two words one edit apart, one half of the first stands unchanged at its end of the second. A word of length m is indexed under
   (side, m, its outer (m - 1) // 2 letters) and asks for the same key of lengths m - 1, m and m + 1, which covers every partner.
   Keys are hashed to shards of about ``SHARD`` words; a key that more words share is dealt into cells, and its queries go to each of them.
3. *Index.* A shard's words, each between delimiters, are one text with two suffix arrays, of the text and of its reverse. A pattern is a pair of
   suffix-rank intervals, one in each, kept in step by wavelet-matrix ranks while it grows at either end.
4. *Search schemes.* The left half is matched exactly from its last letter to the delimiter, then extended to the right allowing one
   error; the right half exactly to the closing delimiter, then to the left. All patterns of a shard advance a letter at a time.
5. *Forms.* A word's form is its most frequent near word, if frequent enough; roots follow forms by pointer jumping, as joins.

Memory of a task follows the words of its shard (some 200 bytes a letter). Nothing reaches the driver but the size of the vocabulary.

Defined results: NULL and empty texts have no words; a NULL id reads as empty text in the key of the alteration; repeated rows count again;
ties of counts go to the smaller word in code-point order; words shorter than ``least_length`` or rarer than ``least_count`` are neither words nor near
words; an empty table has no words; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from funnelspark.session import materialise

#: Letters of a word: ASCII and the code points C0 to FF.
LETTERS = "A-Za-zÀ-ÿ"
#: Words of a shard, and of a cell of a key that many words share.
SHARD, CELL = 20_000, 20_000


def altered(doc_id: Column, run: Column, modulus: int = 31) -> Column:
    """The run without one letter where ``modulus`` divides crc32 of ``<doc_id>:<run>``; that crc32 modulo the length tells which."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % modulus == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, misspelled=None, least_length: int = 7, least_count: int = 2, text: str = "text") -> DataFrame:
    """(word, n) of all words of at least that length and count; ``misspelled(doc_id, run)`` gives the word of a run, the run itself if None."""
    # A match begins where a run begins: shorter runs hold none, longer ones are taken whole.
    runs = F.regexp_extract_all(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    each = docs.select("doc_id", F.explode(runs).alias("run"))
    words = each.select((misspelled(F.col("doc_id"), F.col("run")) if misspelled else F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


class Wavelet:
    """Wavelet matrix of a sequence of small numbers: ranks of many intervals at once."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for k in range(self.bits - 1, -1, -1):
            bit = (values >> k & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate((values[~bit], values[bit]))
        # Where the run of each symbol begins once all bits are sorted.
        self.start = np.searchsorted(self._spread(values), self._spread(np.arange(1 << self.bits)))

    def _spread(self, values: np.ndarray) -> np.ndarray:
        """Values in the order of the last level: by their lowest bit first."""
        out = np.zeros_like(values)
        for k in range(self.bits):
            out |= (values >> k & 1) << (self.bits - 1 - k)
        return out

    def follow(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Occurrences of the symbol before lo and before hi, and those of smaller symbols in between."""
        smaller = np.zeros(len(lo), np.int64)
        lo, hi = lo.copy(), hi.copy()
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = (symbol >> (self.bits - 1 - k) & 1).astype(bool)
            a, b = ones[lo], ones[hi]
            smaller += np.where(up, (hi - lo) - (b - a), 0)
            lo, hi = np.where(up, zeros + a, lo - a), np.where(up, zeros + b, hi - b)
        return lo - self.start[symbol], hi - self.start[symbol], smaller

    def branch(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same for every symbol that stands in each interval: (interval, symbol, before lo, before hi, smaller)."""
        at, symbol, smaller = np.arange(len(lo)), np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            a, b = ones[lo].astype(np.int64), ones[hi].astype(np.int64)
            few = (hi - b) - (lo - a)
            low, high = few > 0, b > a
            at = np.concatenate((at[low], at[high]))
            symbol = np.concatenate((2 * symbol[low], 2 * symbol[high] + 1))
            smaller = np.concatenate((smaller[low], (smaller + few)[high]))
            lo, hi = np.concatenate(((lo - a)[low], (zeros + a)[high])), np.concatenate(((hi - b)[low], (zeros + b)[high]))
        return at, symbol, lo - self.start[symbol], hi - self.start[symbol], smaller


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes, by doubling; a suffix that ends first is the smaller."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, step = len(text), 1
    while True:
        second = np.zeros(n, np.int64)
        second[:-step] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        step *= 2
        if step >= n:
            return order


class BidirectionalIndex:
    """Suffix-rank intervals of a text (``lo``) and of its reverse (``back``), both ``width`` long, of patterns that grow at either end."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.order = suffix_array(text)
        back = suffix_array(text[::-1])
        # The symbol before each suffix; the text counts as a ring, whose ends are delimiters of no word.
        self.left, self.right = Wavelet(text[self.order - 1], symbols), Wavelet(text[::-1][back - 1], symbols)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))

    def whole(self, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.zeros(count, np.int64), np.zeros(count, np.int64), np.full(count, self.less[-1], np.int64)

    def _sides(self, rightwards: bool) -> Wavelet:
        return self.right if rightwards else self.left

    def grow(self, state, symbol: np.ndarray, rightwards: bool):
        """State of each pattern with the symbol added at one end; an empty interval has width 0."""
        lo, back, width = state
        main, other = (back, lo) if rightwards else (lo, back)
        a, b, smaller = self._sides(rightwards).follow(symbol, main, main + width)
        main, other = self.less[symbol] + a, other + smaller
        return (other, main, b - a) if rightwards else (main, other, b - a)

    def spread(self, state, rightwards: bool):
        """(pattern, symbol, state) of every extension that occurs."""
        lo, back, width = state
        main, other = (back, lo) if rightwards else (lo, back)
        at, symbol, a, b, smaller = self._sides(rightwards).branch(main, main + width)
        main, other = self.less[symbol] + a, other[at] + smaller
        return at, symbol, ((other, main, b - a) if rightwards else (main, other, b - a))


def _take(state, index):
    return tuple(s[index] for s in state)


def _join(states):
    return tuple(np.concatenate(parts) for parts in zip(*states))


class _Words:
    """Words of a shard as letters end to end."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)


def near_pairs(words: list[str], queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) numbers of all pairs that differ by exactly one inserted, deleted or replaced letter, one half of the query being unchanged."""
    index, asked = _Words(words), _Words(queries)
    alphabet = np.unique(index.letters)
    symbols = len(alphabet) + 2  # 0 begins the text, 1 is the delimiter
    text = np.ones(len(index.letters) + len(words) + 2, np.int64)
    text[0] = 0
    text[np.arange(len(index.letters)) + np.repeat(np.arange(len(words)), index.size) + 2] = np.searchsorted(alphabet, index.letters) + 2
    fm = BidirectionalIndex(text, symbols)
    begins = index.first + np.arange(len(words)) + 1  # place of the delimiter before each word
    known = np.searchsorted(alphabet, asked.letters)
    known = np.where(alphabet[np.minimum(known, len(alphabet) - 1)] == asked.letters, known + 2, -1)
    found = [_scheme(fm, asked, known, half, begins) for half in ("left", "right")]
    pair = np.unique(np.concatenate([q * len(words) + w for q, w in found]))
    return pair // len(words), pair % len(words)


def _exact(fm: BidirectionalIndex, state, symbol: np.ndarray, rightwards: bool):
    """The patterns that still occur with the symbol added (letters that the index lacks do not), and which these are."""
    alive = np.flatnonzero(symbol >= 0)
    grown = fm.grow(_take(state, alive), symbol[alive], rightwards)
    kept = grown[2] > 0
    return alive[kept], _take(grown, kept)


def _scheme(fm: BidirectionalIndex, asked: _Words, known: np.ndarray, half: str, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One half exactly, from the middle of the word to its delimiter, then the other from the middle outwards with one error."""
    rightwards = half == "left"  # where the errors are looked for
    middle = asked.size // 2
    steps = middle if half == "left" else asked.size - middle
    query, state = np.arange(len(asked.size)), fm.whole(len(asked.size))
    for k in range(int(steps.max()) + 1):
        at = asked.first[query] + (middle[query] - 1 - k if half == "left" else middle[query] + k)
        # After its last letter the half is closed by the delimiter; what is closed waits.
        symbol = np.where(k < steps[query], known[np.clip(at, 0, len(known) - 1)], 1)
        waits = np.flatnonzero(k > steps[query])
        goes = np.flatnonzero(k <= steps[query])
        alive, grown = _exact(fm, _take(state, goes), symbol[goes], not rightwards)
        query, state = np.concatenate((query[waits], query[goes[alive]])), _join([_take(state, waits), grown])
    rest = asked.size - steps
    done = np.zeros(len(query), np.int64)  # letters of the rest that are accounted for
    wrong_q, wrong_d, wrong_s = query[:0], done[:0], _take(state, slice(0, 0))
    hits = []
    for _ in range(int(rest.max()) + 2):
        if not len(query) and not len(wrong_q):
            break
        # Patterns with their error behind them: one more letter, then the delimiter.
        if len(wrong_q):
            ends = wrong_d == rest[wrong_q]
            alive, grown = _exact(fm, wrong_s, np.where(ends, 1, _symbol(asked, known, middle, rest, wrong_q, wrong_d, rightwards)), rightwards)
            closed = ends[alive]
            hits.append((wrong_q[alive[closed]], _place(fm, _take(grown, closed), rightwards, begins)))
            keep = alive[~closed]
            wrong_q, wrong_d, wrong_s = wrong_q[keep], wrong_d[keep] + 1, _take(grown, ~closed)
        if len(query):
            ended = done == rest[query]
            own = np.where(ended, -1, _symbol(asked, known, middle, rest, query, done, rightwards))
            at, symbol, grown = fm.spread(state, rightwards)
            letter = symbol >= 2
            other, same = letter & (symbol != own[at]) & ~ended[at], letter & (symbol == own[at])
            # Inserted, replaced, and left out.
            made = [(query[at[letter]], done[at[letter]], _take(grown, letter)), (query[at[other]], done[at[other]] + 1, _take(grown, other))]
            made.append((query[~ended], done[~ended] + 1, _take(state, ~ended)))
            wrong_q, wrong_d = np.concatenate([wrong_q, *(m[0] for m in made)]), np.concatenate([wrong_d, *(m[1] for m in made)])
            wrong_s = _join([wrong_s, *(m[2] for m in made)])
            query, done, state = query[at[same]], done[at[same]] + 1, _take(grown, same)
    return (np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])) if hits else (query[:0], query[:0])


def _symbol(asked: _Words, known: np.ndarray, middle: np.ndarray, rest: np.ndarray, query: np.ndarray, done: np.ndarray, rightwards: bool) -> np.ndarray:
    """The next letter of the rest, outwards."""
    at = asked.first[query] + (middle[query] + done if rightwards else middle[query] - 1 - done)
    return known[np.clip(at, 0, len(known) - 1)]


def _place(fm: BidirectionalIndex, state, rightwards: bool, begins: np.ndarray) -> np.ndarray:
    """Number of the one word of each closed pattern: all words of a shard differ."""
    return np.searchsorted(begins, fm.order[state[0]])


def _outer(side: int, length: Column, word: Column) -> Column:
    """The letters of a word that a partner of that length shares at one end."""
    k = F.floor((length - 1) / 2).cast("int")
    return F.substring(word, F.lit(1), k) if side == 0 else F.substring(word, F.length(word) - k + 1, k)


def near_words(words: DataFrame, shard: int = SHARD, cell: int = CELL) -> DataFrame:
    """(word, near, n): every pair of distinct words one edit apart, in both directions, with the count of the near word. ``words``: word, n."""
    count = words.count()
    hashed = max(1, -(-count // shard))

    def key(side: int, length: Column) -> Column:
        return F.xxhash64(F.lit(side), length, _outer(side, length, F.col("word")))

    size = F.length("word")
    homes = F.array(*(F.struct(F.lit(s).alias("side"), key(s, size).alias("key")) for s in (0, 1)))
    asks = F.array(*(F.struct(F.lit(s).alias("side"), key(s, size + d).alias("key")) for s in (0, 1) for d in (-1, 0, 1)))
    home = words.select("word", "n", F.explode(homes).alias("_h")).select("word", "n", "_h.side", "_h.key")
    cells = home.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("cells")).where("cells > 1")
    cells = materialise(cells, "spelling-cells").withColumnRenamed("key", "_key")
    hot = F.coalesce("cells", F.lit(1))
    place = lambda c: F.concat_ws("/", "side", F.pmod(F.xxhash64("key", c), F.lit(hashed)).cast("string")).alias("shard")
    home = home.join(cells, F.col("key") == F.col("_key"), "left").select(place(F.pmod(F.xxhash64("word"), hot).cast("int")), "word", "n")
    ask = words.select("word", F.explode(asks).alias("_h")).select("word", "_h.side", "_h.key").join(cells, F.col("key") == F.col("_key"), "left")
    ask = ask.withColumn("_c", F.explode(F.sequence(F.lit(0), hot - 1))).select(place(F.col("_c")), "word", F.lit(None).cast("long").alias("n"))

    def run(table: pa.Table) -> pa.Table:
        word, n = table.column("word").to_pylist(), np.asarray(table.column("n").fill_null(0))
        own = sorted({w: c for w, c in zip(word, n.tolist()) if c}.items())
        ask = sorted({w for w, c in zip(word, n.tolist()) if not c})
        if not own or not ask:
            return pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
        q, w = near_pairs([x for x, _ in own], ask)
        return pa.table({"word": pa.array(ask).take(pa.array(q)), "near": pa.array([x for x, _ in own]).take(pa.array(w)), "n": pa.array([c for _, c in own], pa.int64()).take(pa.array(w))})

    pairs = home.unionByName(ask).groupBy("shard").applyInArrow(run, "word string, near string, n long")
    return pairs.distinct()


def variants(words: DataFrame, times: int = 10, shard: int = SHARD, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word. ``words``: word, n, the words distinct."""
    words = materialise(words.select("word", "n"), "spelling-words")
    near = near_words(words, shard, cell)
    # Largest count first, then the smallest word: code-point order is the order of UTF-8 bytes.
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near"))).alias("_b"))
    known = words.join(best, "word", "left")
    often = -F.col("_b.less") >= times * F.col("n")
    known = known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(often, F.col("_b.near")).alias("form"), F.when(often, -F.col("_b.less")).alias("form_n"))
    known = materialise(known, "spelling-forms")
    roots = roots_of(known.where("form is not null").select("word", F.col("form").alias("root")))
    out = known.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of (word, root) steps. Counts grow along a chain, so it ends."""
    forms = materialise(forms, "spelling-roots")
    while True:
        further = forms.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = forms.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = materialise(step, "spelling-roots")
        forms = step.select("word", "root")
        if step.where("moved").isEmpty():
            return forms


def spelling_variants(docs: DataFrame, misspelled=None, times: int = 10, least_length: int = 7, least_count: int = 2, text: str = "text") -> DataFrame:
    """:func:`variants` of the vocabulary of ``docs``."""
    return variants(vocabulary(docs, misspelled, least_length, least_count, text), times)
