"""Language identification by unigram pieces: each language has probabilities for the
pieces of one fixed public vocabulary, and a word's probability is the sum over all
its segmentations into pieces."""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import frozen, table
from kiln.llm.registry import query
from kiln.llm.sample import fold_of

#: Byte-level vocabulary for many languages: a piece in base64 and its number on each line.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_POINT = 1 << 20  # expected counts are added up as multiples of 1 / _POINT, in any order


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, in lower case and composed form. A run may
    hold other numerals, which ``unit_of`` takes out."""
    return _WORD.findall(unicodedata.normalize("NFC", text).lower())


def unit_of(word: str) -> bytes:
    """What is segmented: a space and the letters in UTF-8; empty without a letter."""
    letters = word if word.isalpha() else "".join(c for c in word if c.isalpha())
    return b" " + letters.encode("utf-8", "replace") if letters else b""


@dataclass(frozen=True)
class Pieces:
    """The pieces that can occur in a unit, as a trie: ``edges`` (node * 256 + byte,
    sorted) lead to ``child``; ``piece`` numbers the nodes that end one, else -1."""
    names: list[bytes]
    edges: np.ndarray
    child: np.ndarray
    piece: np.ndarray

    @classmethod
    def of(cls, vocabulary) -> Pieces:
        """Trie of the pieces made of letters a-z and bytes above 127, also after a
        space; every single byte is a piece, so that any unit can be segmented."""
        def fits(p):
            return all(b >= 128 or 97 <= b <= 122 for b in p.removeprefix(b" "))
        names = sorted({p for p in vocabulary if p and fits(p)} | {bytes([b]) for b in (32, *range(97, 123), *range(128, 256))})
        nodes: dict[int, int] = {}
        piece = [-1]
        for number, p in enumerate(names):
            node = 0
            for b in p:
                if (edge := node * 256 + b) not in nodes:
                    nodes[edge] = len(piece)
                    piece.append(-1)
                node = nodes[edge]
            piece[node] = number
        edges = np.array(sorted(nodes), np.int64)
        return cls(names, edges, np.array([nodes[e] for e in edges.tolist()], np.int64), np.array(piece, np.int64))

    @classmethod
    def read(cls, path: str) -> Pieces:
        with open(path, "rb") as f:
            return cls.of(base64.b64decode(line.split()[0]) for line in f if line.strip())

    def lattice(self, units: list[bytes]) -> Lattice:
        """Every place of a piece in each unit."""
        sizes = np.array([len(u) for u in units], np.int64)
        text = np.frombuffer(b"".join(units), np.uint8).astype(np.int64)
        owner = np.repeat(np.arange(len(units)), sizes)
        begin = np.cumsum(sizes) - sizes
        stop = (begin + sizes)[owner] if len(text) else begin
        start, node, step = np.arange(len(text)), np.zeros(len(text), np.int64), 0
        found = [(start[:0], start[:0], start[:0])]
        while len(start):
            edge = node * 256 + text[start + step]
            i = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            live = self.edges[i] == edge
            start, node = start[live], self.child[i[live]]
            step += 1
            ends = self.piece[node] >= 0
            found.append((start[ends], start[ends] + step, self.piece[node[ends]]))
            more = start + step < stop[start]
            start, node = start[more], node[more]
        a, z, piece = (np.concatenate(x) for x in zip(*found))
        unit = owner[a]
        # boundaries of unit u are rows begin[u] + u onward, one more than its bytes
        return Lattice(sizes, begin + np.arange(len(units)), unit, a - begin[unit], z - begin[unit], piece)


@dataclass(frozen=True)
class Lattice:
    sizes: np.ndarray
    base: np.ndarray
    unit: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray

    def _pass(self, logp: np.ndarray, frm: np.ndarray, to: np.ndarray, seed: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all ways from ``seed`` to each boundary."""
        out = np.full((int(self.sizes.sum()) + len(self.sizes), logp.shape[1]), -np.inf)
        out[seed] = 0.0
        far = np.abs(to - (seed - self.base)[self.unit])
        order = np.lexsort((self.unit, far))
        cuts = np.searchsorted(far[order], np.arange(1, int(far.max(initial=0)) + 2))
        for a, z in zip(cuts, cuts[1:]):
            e = order[a:z]
            if not len(e):
                continue
            unit = self.unit[e]
            value = out[self.base[unit] + frm[e]] + logp[self.piece[e]]
            first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
            top = np.maximum.reduceat(value, first)
            n = np.diff(np.concatenate([first, [len(e)]]))
            total = np.add.reduceat(np.exp(value - np.repeat(top, n, axis=0)), first)
            out[self.base[unit[first]] + to[e[first]]] = top + np.log(total)
        return out

    def forward(self, logp: np.ndarray) -> np.ndarray:
        return self._pass(logp, self.start, self.end, self.base)

    def marginals(self, logp: np.ndarray) -> np.ndarray:
        """Log probability of each unit, one column for each of ``logp``: the sum
        over all its segmentations."""
        return self.forward(logp)[self.base + self.sizes]

    def expected(self, logp: np.ndarray) -> np.ndarray:
        """Expected count of each place of a piece, given its unit (one column)."""
        ahead = self.forward(logp)
        back = self._pass(logp, self.end, self.start, self.base + self.sizes)
        at = self.base[self.unit]
        whole = ahead[at + self.sizes[self.unit]]
        return np.exp(ahead[at + self.start] + logp[self.piece] + back[at + self.end] - whole)[:, 0]


@dataclass(frozen=True)
class LanguageModel:
    """``logp``: pieces by languages; ``prior``: log share of each language."""
    pieces: Pieces
    langs: list[str]
    prior: np.ndarray
    logp: np.ndarray


def word_counts(rows: DataFrame, held_words: int = 200_000) -> DataFrame:
    """(lang, word, n) of rows (lang, text), added up in each task first."""
    def parts(batches):
        held: Counter = Counter()
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                held.update((lang, w) for w in words_of(text.as_py()))
                if len(held) >= held_words:
                    yield emit(held)
                    held = Counter()
        if held:
            yield emit(held)

    def emit(held):
        return pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in held]), "word": pa.array([k[1] for k in held]),
                                           "n": pa.array(list(held.values()), pa.int64())})
    return rows.mapInArrow(parts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit_languages(rows: DataFrame, sizes: dict[str, int], pieces: Pieces, rounds: int = 3, prior: float = 500.0) -> LanguageModel:
    """Model of the languages in ``sizes`` (texts known of each) from labelled rows
    (lang, text), a bounded sample.

    Piece probabilities start equal; each of ``rounds`` adds up the expected counts
    of pieces over all segmentations of the counted words and divides them. Counts
    are added as whole numbers, so that reruns agree. At the end a language's counts
    get ``prior`` occurrences more, spread as in the mean of all languages.

    The driver holds languages x pieces; the words stay in the cluster.
    """
    langs = sorted(sizes)
    counts = frozen(word_counts(rows).repartition("word"))
    logp = np.full((len(pieces.names), len(langs)), -np.log(len(pieces.names)))
    column = {lang: i for i, lang in enumerate(langs)}
    share = np.exp(logp)
    for _ in range(rounds):
        def add(batches, logp=logp):
            for b in batches:
                unit = [unit_of(w) for w in b.column("word").to_pylist()]
                lang, n = np.array([column[x] for x in b.column("lang").to_pylist()]), b.column("n").to_numpy()
                for which in np.unique(lang):
                    own = [i for i in np.flatnonzero(lang == which) if unit[i]]
                    if not own:
                        continue
                    lattice = pieces.lattice([unit[i] for i in own])
                    amount = np.rint(lattice.expected(logp[:, [which]]) * n[own][lattice.unit] * _POINT)
                    total = np.bincount(lattice.piece, amount)
                    used = np.flatnonzero(total)
                    yield pa.RecordBatch.from_pydict({"lang": pa.array(np.full(len(used), which, np.int32)), "piece": pa.array(used.astype(np.int32)),
                                                      "amount": pa.array(total[used].astype(np.int64))})
        sums = counts.mapInArrow(add, "lang int, piece int, amount long").groupBy("lang", "piece").agg(F.sum("amount").alias("amount")).toArrow()
        amount = np.zeros_like(logp)
        amount[sums.column("piece").to_numpy(), sums.column("lang").to_numpy()] = sums.column("amount").to_numpy() / _POINT
        mean = (amount / np.maximum(amount.sum(0), 1)).mean(1) + 1e-9
        mean /= mean.sum()
        share = (amount + prior * mean[:, None]) / (amount.sum(0) + prior)
        logp = np.log(share)
    n = np.array([sizes[x] for x in langs], float)
    return LanguageModel(pieces, langs, np.log(n / n.sum()), logp)


def learn_languages(docs: DataFrame, allowed, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    max_docs: int = 5000, **options) -> LanguageModel | None:
    """Model from the rows that satisfy ``allowed`` and have a text and a language;
    None without any. About ``max_docs`` texts of each language are read, by a hash
    of the id, so that rare languages are learned from all their texts."""
    known = docs.where(allowed & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()) \
                .select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = known.groupBy("lang").count()
    found = {r["lang"]: r["count"] for r in sizes.collect()}  # the languages, which the model holds too
    if not found:
        return None
    span = 1 << 30
    part = F.pmod(F.xxhash64(F.lit("lang"), "_id"), F.lit(span)) < F.lit(span) * F.least(F.lit(1.0), F.lit(max_docs) / F.col("count"))
    rows = known.join(F.broadcast(sizes), "lang").where(part).select("lang", "text")
    return fit_languages(rows, found, Pieces.read(path), **options)


def predict_language(docs: DataFrame, model: LanguageModel | None, text_col: str = "text", name: str = "lang_pred",
                     score: str = "score", chunk_chars: int = 1 << 20, held_words: int = 300_000) -> DataFrame:
    """``docs`` with the likeliest language of each whole text and its probability
    (0 to 1) added or replaced. Texts without a letter, null ones too, and all texts
    without a model are ``und`` with 0. Of equal languages the first by UTF-8 wins.

    A row gives a row, repeated ones the same answer; other columns are kept. A task
    keeps the scores of ``held_words`` distinct words at most and reads about
    ``chunk_chars`` characters at a time.
    """
    names = [c for c in docs.columns if c not in (name, score)]
    kept = docs.select(*[F.col(f"`{c}`") for c in names])
    if model is None:
        return kept.withColumn(name, F.lit(UNKNOWN)).withColumn(score, F.lit(0.0))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields) + f", `{name}` string, `{score}` double"

    def answers(batches):
        place: dict[str, int] = {}
        values = np.empty((0, len(model.langs)))
        for b in batches:
            pred, prob, group, chars = [], [], [], 0
            texts = b.column(text_col)
            for i, text in enumerate(texts):
                group.append(Counter(words_of(text.as_py() or "")))
                chars += len(text.as_py() or "")
                if chars < chunk_chars and i + 1 < len(texts):
                    continue
                if len(place) > held_words:
                    place, values = {}, values[:0]
                new = [w for w in dict.fromkeys(w for c in group for w in c) if w not in place]
                place.update(zip(new, range(len(place), len(place) + len(new))))
                values = np.concatenate([values, _log_probabilities(model, new)])
                for lang, p in _decide(model, group, place, values):
                    pred.append(lang)
                    prob.append(p)
                group, chars = [], 0
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(prob, pa.float64())], names=[*names, name, score])
    return kept.mapInArrow(answers, schema)


def _log_probabilities(model: LanguageModel, words: list[str]) -> np.ndarray:
    """Log probability of each word in each language; NaN without a letter."""
    units = [unit_of(w) for w in words]
    out = np.full((len(words), len(model.langs)), np.nan)
    has = [i for i, u in enumerate(units) if u]
    if has:
        out[has] = model.pieces.lattice([units[i] for i in has]).marginals(model.logp)
    return out


def _decide(model: LanguageModel, group: list[Counter], place: dict, values: np.ndarray):
    """(language, probability) of each text from its counted words."""
    size = [len(c) for c in group]
    doc = np.repeat(np.arange(len(group)), size)
    at = np.fromiter((place[w] for c in group for w in c), np.int64, len(doc))
    n = np.fromiter((k for c in group for k in c.values()), np.float64, len(doc))
    good = ~np.isnan(values[at, 0])
    doc, n, rows = doc[good], n[good], values[at[good]]
    seen = np.bincount(doc, minlength=len(group)) > 0
    total = np.stack([np.bincount(doc, n * rows[:, k], len(group)) for k in range(len(model.langs))], axis=1) + model.prior
    best = total.argmax(1)
    prob = 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)
    return [(model.langs[k], float(p)) if s else (UNKNOWN, 0.0) for k, p, s in zip(best, prob, seen)]


@query("op11_language_id")
def op11_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs, fold_of("doc_id", 3).isin(0, 2))
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
