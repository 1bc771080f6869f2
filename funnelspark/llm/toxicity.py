"""Toxicity scores: a lexicon trie met with Levenshtein automata, and context windows around each hit.

The lexicon is learned from labelled documents: words that stand in many different contexts of toxic documents and in few of
others (contexts, not occurrences, so that copies of a text count once). Its trie is intersected with the Levenshtein
automaton of every term and made deterministic once: a state is a set of (trie node, edits used). Words of a text slice walk
this table in lockstep and nearly all are dead after two or three letters, so misspelt terms cost no more than exact ones.

Each hit is judged in its window of words: inside quotation marks or after a verb of saying it counts as quotation, else as
abuse; address in the second person nearby is a feature of its own. A small logistic model over the document's features gives
the score.

Defined results: NULL and empty texts score as texts without hits; repeated label rows count once, at the larger label; labels
outside 0 and 1 are left out; without labels the lexicon is empty and every score is 0.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from funnelspark.llm.frames import append, keep_rows, labelled_sample
from funnelspark.llm.ragged import LOWER, text_bytes, word_spans

#: Words on each side that make up the context of a hit.
WINDOW = 6
#: Terms of one automaton; a larger lexicon is several automata, run one after another.
TERMS = 200
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
# Digits that stand for letters, folded with A-Z in texts and terms alike.
DIGITS, LETTERS = "013457", "oieast"
_FOLD = LOWER.copy()
for _a, _b in zip(DIGITS.encode(), LETTERS.encode()):
    _FOLD[_a] = _b
# Function words of quotation and of address (fixed values).
SAYING = ("said", "says", "say", "wrote", "writes", "quoted", "quote", "called", "word", "term", "sagte", "schrieb", "dijo", "dit", "zitat")
ADDRESS = ("you", "your", "youre", "du", "dein", "tu", "toi", "vous", "usted", "eres")
FEATURES = ("bias", "abuse", "fuzzy", "quoted", "density", "terms", "address", "any")


def folded(term: str) -> bytes:
    """A term as the bytes of a text are folded."""
    return _FOLD[np.frombuffer(term.encode(), np.uint8)].tobytes()


def _edits(term: bytes) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Automaton:
    """Deterministic table of the trie of ``terms`` intersected with their Levenshtein automata."""

    def __init__(self, terms: list[str]) -> None:
        self.terms = sorted({folded(t) for t in terms if t})
        letters = sorted({b for t in self.terms for b in t})
        self.symbol = np.zeros(256, np.int64)  # 0: a byte of no term
        for k, b in enumerate(letters):
            self.symbol[b] = k + 1
        # Trie: node -> children by symbol; ``room`` is the largest edit budget below a node.
        child: list[dict[int, int]] = [{}]
        final: dict[int, int] = {}
        budget = [0]
        for k, t in enumerate(self.terms):
            node, most = 0, _edits(t)
            budget[0] = max(budget[0], most)
            for b in t:
                s = int(self.symbol[b])
                if s not in child[node]:
                    child.append({})
                    budget.append(0)
                    child[node][s] = len(child) - 1
                node = child[node][s]
                budget[node] = max(budget[node], most)
            final[node] = k

        def closed(found: dict[int, int]) -> frozenset:
            """Adds what deleting letters of a term reaches; keeps the fewest edits of each node."""
            todo = list(found.items())
            while todo:
                node, e = todo.pop()
                if found[node] < e:
                    continue
                for nxt in child[node].values():
                    if e + 1 <= budget[nxt] and found.get(nxt, 99) > e + 1:
                        found[nxt] = e + 1
                        todo.append((nxt, e + 1))
            return frozenset(found.items())

        first = closed({0: 0})
        states, rows = {first: 1, frozenset(): 0}, [None, first]
        table: list[list[int]] = [[0] * (len(letters) + 1)]
        k = 1
        while k < len(rows):
            line = []
            for s in range(len(letters) + 1):
                found: dict[int, int] = {}
                for node, e in rows[k]:
                    nxt = child[node].get(s)
                    if nxt is not None and e <= budget[nxt]:
                        found[nxt] = min(found.get(nxt, 99), e)
                    if e + 1 <= budget[node]:  # the text has a letter more
                        found[node] = min(found.get(node, 99), e + 1)
                    for other, n in child[node].items():  # another letter
                        if other != s and e + 1 <= budget[n]:
                            found[n] = min(found.get(n, 99), e + 1)
                state = closed(found)
                if state not in states:
                    states[state] = len(rows)
                    rows.append(state)
                line.append(states[state])
            table.append(line)
            k += 1
        self.next = np.array(table, np.int32)
        self.term = np.full(len(rows), -1, np.int32)
        self.edits = np.full(len(rows), 99, np.int32)
        for i, state in enumerate(rows[1:], 1):
            ends = [(e, final[n]) for n, e in state if n in final and e <= _edits(self.terms[final[n]])]
            if ends:
                self.edits[i], self.term[i] = min(ends)

    def match(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest term (or -1) and edits of each word of folded bytes."""
        state = np.ones(len(start), np.int32)
        live = np.arange(len(start))
        out = np.zeros(len(start), np.int32)
        at = start.copy()
        while len(live):
            ended = at >= end[live]
            out[live[ended]] = state[ended]
            live, at, state = live[~ended], at[~ended], state[~ended]
            state = self.next[state, self.symbol[data[at]]]
            ok = state > 0
            live, at, state = live[ok], at[ok] + 1, state[ok]
        return self.term[out], self.edits[out]


class Lexicon:
    """All ``terms``, in automata of at most ``size`` of them; matches as one automaton of all would."""

    def __init__(self, terms: list[str], size: int = TERMS) -> None:
        self.terms = sorted({folded(t) for t in terms if t})
        self.starts = range(0, len(self.terms), size)
        self.parts = [Automaton([t.decode() for t in self.terms[k : k + size]]) for k in self.starts]

    def match(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest term (or -1) and edits of each word of folded bytes; of equally near terms the first."""
        term, edits = np.full(len(start), -1, np.int32), np.full(len(start), 99, np.int32)
        for first, part in zip(self.starts, self.parts):
            t, e = part.match(data, start, end)
            better = e < edits
            term[better], edits[better] = t[better] + first, e[better]
        return term, edits


def _is_word(data: np.ndarray, start: np.ndarray, end: np.ndarray, words: tuple[str, ...]) -> np.ndarray:
    out = np.zeros(len(start), bool)
    for w in words:
        b = np.frombuffer(w.encode(), np.uint8)
        some = np.flatnonzero(end - start == len(b))
        for j, c in enumerate(b):
            some = some[data[start[some] + j] == c]
        out[some] = True
    return out


def features(column: pa.Array, automaton: Automaton | Lexicon) -> np.ndarray:
    """One row of :data:`FEATURES` per text."""
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    low = _FOLD[data]
    start, end, row = word_spans(data, offsets, _WORD[data])
    words = np.bincount(row, minlength=n)
    term, edits = automaton.match(low, start, end)
    hit = np.flatnonzero(term >= 0)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = 1
    if not len(hit):
        return out
    quote = np.concatenate(([0], np.cumsum(data == 34)))
    a, b = np.maximum(hit - WINDOW, 0), np.minimum(hit + WINDOW, len(start) - 1)
    first = np.concatenate(([0], np.cumsum(words)))[row[hit]]
    last = first + words[row[hit]] - 1
    a, b = np.maximum(a, first), np.minimum(b, last)
    # Quotation: an odd number of marks since the text began, and a closing mark inside the window or a verb of saying before it.
    opened = (quote[start[hit]] - quote[offsets[row[hit]]]) % 2 == 1
    closing = quote[end[b]] > quote[end[hit]]
    near = lambda flags: np.concatenate(([0], np.cumsum(flags)))
    plain = LOWER[data]
    saying, address = near(_is_word(plain, start, end, SAYING)), near(_is_word(plain, start, end, ADDRESS))
    quoted = (opened & closing) | (saying[hit] > saying[a])
    exact = edits[hit] == 0
    r = row[hit]
    abuse = np.bincount(r[exact & ~quoted], minlength=n)
    out[:, 1] = np.log1p(abuse)
    out[:, 2] = np.log1p(np.bincount(r[~exact & ~quoted], minlength=n))
    out[:, 3] = np.log1p(np.bincount(r[quoted], minlength=n))
    out[:, 4] = np.sqrt(abuse / np.maximum(words, 1))
    out[:, 5] = np.log1p(np.bincount(np.unique(r[~quoted] * (len(automaton.terms) + 1) + term[hit][~quoted]) // (len(automaton.terms) + 1), minlength=n))
    out[:, 6] = np.bincount(r[~quoted & (address[b + 1] > address[a])], minlength=n) > 0
    out[:, 7] = abuse > 0
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> np.ndarray:
    """Newton steps of a ridge-penalised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, automaton: Automaton | Lexicon, weights: np.ndarray) -> None:
        self.automaton, self.weights = automaton, weights

    def score(self, column: pa.Array) -> np.ndarray:
        if not len(self.weights):
            return np.zeros(len(column))
        return 1 / (1 + np.exp(-np.clip(features(column, self.automaton) @ self.weights, -30, 30)))


def lexicon(rows: DataFrame, least: int = 8, purity: float = 0.8) -> list[str]:
    """Words of ``rows`` (doc_id, text, label) that many documents use in contexts of their own, nearly all of label 1.

    A context (the words before and after) belongs to the first document that has it, so copies of a text and repetitive
    texts count once. One aggregation over contexts; the words found reach the driver, as many as the labelled sample bears out.
    """
    same = F.translate("text", ascii_uppercase + DIGITS, ascii_lowercase + LETTERS)
    words = F.regexp_extract_all(same, F.lit("([a-z0-9\\x80-\\x{10FFFF}]+)"), 1)
    padded = rows.select("doc_id", "label", F.concat(F.array(F.lit("")), words, F.array(F.lit(""))).alias("_w")).where(F.size("_w") > 2)
    triples = F.arrays_zip(F.slice("_w", 2, F.size("_w") - 2).alias("w"), F.slice("_w", 1, F.size("_w") - 2).alias("b"), F.slice("_w", 3, F.size("_w") - 2).alias("a"))
    long = padded.select("doc_id", "label", F.explode(triples).alias("_c"))
    long = long.select(F.col("_c.w").alias("word"), F.xxhash64("_c.b", "_c.a").alias("_k"), "doc_id", "label").where(F.length("word") >= 3)
    first = long.groupBy("word", "_k").agg(F.min(F.struct("doc_id", "label")).alias("_d"))
    by_doc = first.groupBy("word", F.col("_d.doc_id").alias("doc_id")).agg(F.max("_d.label").alias("label"))
    by_word = by_doc.groupBy("word").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n"))
    good = by_word.where((F.col("bad") >= least) & (F.col("bad") >= purity * F.col("n")))
    return [r["word"] for r in good.orderBy(F.desc("bad"), "word").collect()]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 3, held: int = 1, sample: int = 10_000) -> Model:
    """Fits on at most ``sample`` labelled rows outside the held-out fold: lexicon by Spark, weights from 64-byte feature rows."""
    rows = labelled_sample(docs, labels, label, modulus, held, sample)
    automaton = Lexicon(lexicon(rows))
    found = append(rows, "text", [("features", T.ArrayType(T.DoubleType()))], lambda: lambda c: [features(c, automaton).tolist()])
    got = found.select("doc_id", "label", "features").toPandas()
    if got.empty:
        return Model(automaton, np.zeros(0))
    x = np.array(got["features"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort((*x.T, got["doc_id"].to_numpy()))
    return Model(automaton, _logistic(x[order], got["label"].to_numpy(float)[order]))


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= ``threshold``). No shuffle."""
    out = append(docs, text, [("score", T.DoubleType())], lambda: lambda c: [model.score(c)])
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows of ``docs`` below the threshold, all columns as they were."""
    return keep_rows(docs, text, lambda: lambda c: model.score(c) < threshold)
