"""Language identification by interpolated Kneser-Ney character models.

Training: every labelled training text is reduced to letters (lower case) and
single spaces, and Spark sums its character 4-grams per language over all
training documents (each task sends a gram once per language). One pass over
that table gives all orders, as Kneser-Ney's lower orders count distinct
continuations. The probabilities of all languages stand side by side in
hash-sorted arrays, one per order, so a position costs one lookup when any
language knows its 4-gram, and backs off else.

Prediction: the language of the lowest cross-entropy per character. Whether a
text is rejected is decided on windows of ``WINDOW`` letters or so: a window
fits a language if its cross-entropy is at most ``REJECT_Z`` standard
deviations above the mean of the language's own training windows; the deviation
has a part between windows and a part that falls with a window's length, both
measured on all distinct training texts. A text with more than
``REJECT_SHARE`` of its letters in windows that fit no language is rejected, so
texts in several known languages stay and texts half in none go.

Every counted gram is in the model. One of more than ``MAX_CELLS``
probabilities is cut into parts by its grams' middle letters (third, then
second), which all lookups of a position but the last letter's have in common.
Each part goes to the executors on its own; a task holds one part at a time,
scores with it the positions of a block of texts that fall to it, and adds up.

Defined cases: null texts and texts without a letter get ``und``, score 0 and
are rejected; texts of any length are scored whole, in slices; null languages
and languages named by no training text are not learned; repeated rows count
and are scored once each; without training texts all predictions are ``und``;
an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from orderlens.llm.common import mix64, slices

ORDER = 4
#: Probabilities (grams x languages) that a part of the model has; there are as many parts as it takes.
MAX_CELLS = 8_000_000
#: Discount of every order.
DISCOUNT = 0.75
REJECT_Z = 8.0
#: Letters (and spaces) in a window.
WINDOW = 64
#: Share of a kept text's letters that can stand in windows that fit no language.
REJECT_SHARE = 1 / 3
#: Characters turned into letters at once.
SLICE = 1 << 19
#: Positions that a task holds while it goes through the parts of a model.
HELD = 1 << 21
#: Probabilities looked up at once.
AT_ONCE = 1 << 21
UNKNOWN = "und"

_CODES: list[np.ndarray] = []


def _codes() -> np.ndarray:
    """Code point -> 16-bit code: 0 for all but letters; rare planes share codes."""
    if not _CODES:
        table = np.zeros(0x110000, dtype=np.uint16)
        for cp in range(0x110000):
            if chr(cp).isalpha():
                table[cp] = cp if cp < 0x10000 else 0xE000 + cp % 0x1900
        _CODES.append(table)
    return _CODES[0]


def letters(text: str) -> np.ndarray:
    """Codes of the lower-cased text: letters, and one 0 for each run of others, one 0 at both ends."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code = np.empty(len(raw) + 2, dtype=np.uint16)
    code[0] = code[-1] = 0
    np.take(_codes(), raw, out=code[1:-1])
    keep = code != 0
    keep[1:] |= code[:-1] != 0
    keep[0] = True
    return code[keep]


def grams(code: np.ndarray) -> np.ndarray:
    """The 4-grams that end at each code but the first, the start padded with 0; 16 bits a code."""
    wide = np.zeros(len(code) + ORDER - 2, dtype=np.uint64)
    wide[ORDER - 2:] = code
    n = len(code) - 1
    out = wide[:n].copy()
    for k in range(1, ORDER):
        out <<= np.uint64(16)
        out |= wide[k:k + n]
    return out


# --- training ----------------------------------------------------------------

_COUNTS = "lang string, gram long, n long"
#: Codes that a training task holds before it counts them.
_COUNT_AT = 1 << 21


def gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) over rows (lang, text)."""

    def run(batches):
        parts: dict[str, list[np.ndarray]] = {}
        held: dict[str, int] = {}
        counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def count(lang):
            grams_, n = np.unique(np.concatenate(parts.pop(lang)), return_counts=True)
            held[lang] = 0
            if lang in counts:
                old, m = counts[lang]
                grams_, back = np.unique(np.concatenate([old, grams_]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([m, n]), minlength=len(grams_)).astype(np.int64)
            counts[lang] = (grams_, n)

        def rows(lang):
            grams_, n = counts.pop(lang)
            for at in range(0, len(grams_), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams_[part])), pa.array(grams_[part].view(np.int64)), pa.array(n[part].astype(np.int64))],
                    names=["lang", "gram", "n"])

        for batch in slices(batches, "languages"):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for at in range(0, len(text), SLICE):
                    g = grams(letters(text[at:at + SLICE]))
                    parts.setdefault(lang, []).append(g)
                    held[lang] = held.get(lang, 0) + len(g)
                    if held[lang] >= _COUNT_AT:
                        count(lang)
                        if sum(len(x[0]) for x in counts.values()) > 2_000_000:
                            for x in list(counts):
                                yield from rows(x)
        for lang in list(parts):
            count(lang)
        for lang in list(counts):
            yield from rows(lang)

    return texts.select("lang", "text").mapInArrow(run, _COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class HashTable:
    """Values by gram in an array sorted by hash, entered through the hash's top bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        mixed = mix64(keys)
        order = np.argsort(mixed)
        self.hashes = mixed[order]
        self.values = np.ascontiguousarray(values[order], dtype=np.float32)
        bits = max(1, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        bucket = (self.hashes >> self.shift).astype(np.int64)
        self.start = np.searchsorted(bucket, np.arange((1 << bits) + 1)).astype(np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 if it isn't there."""
        out = np.full(len(keys), -1, dtype=np.int32)
        if not len(self.hashes):
            return out
        mixed = mix64(keys)
        bucket = (mixed >> self.shift).astype(np.int64)
        at, end = self.start[bucket], self.start[bucket + 1]
        todo = np.flatnonzero(at < end)
        at, end, mixed = at[todo], end[todo], mixed[todo]
        while len(todo):
            hit = self.hashes[at] == mixed
            out[todo[hit]] = at[hit]
            more = ~hit
            more &= at + 1 < end
            todo, at, end, mixed = todo[more], at[more] + 1, end[more], mixed[more]
        return out


class Model:
    """Log probabilities of all languages, by order, with back-off weights."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], below: dict[str, dict] | None = None):
        """From each language's sorted 4-grams and counts; ``below`` has orders 1 and 2 when these are a part of the 4-grams."""
        self.langs = sorted(counts)
        width = len(self.langs)
        per_lang = [self._orders(*counts[x]) | (below[x] if below else {}) for x in self.langs]
        letters_ = reduce(np.union1d, [p[1][0][0] for p in per_lang], np.zeros(1, np.uint64))
        # order 1: distinct continuations, shared with the uniform share of letters never seen
        uniform = 1.0 / (len(letters_) + 1)
        self.unseen = np.zeros(width)
        known = [letters_]
        prob = [np.zeros((len(letters_), width))]
        for j, p in enumerate(per_lang):
            (keys, n), _ = p[1]
            total = n.sum()
            spread = DISCOUNT * len(keys) / total
            self.unseen[j] = spread * uniform
            prob[0][:, j] = spread * uniform
            prob[0][np.searchsorted(letters_, keys), j] += np.maximum(n - DISCOUNT, 0) / total
        backoff = []
        for k in range(2, ORDER + 1):
            keys = reduce(np.union1d, [p[k][0][0] for p in per_lang])
            contexts = reduce(np.union1d, [p[k][1][0] for p in per_lang])
            low = np.uint64((1 << (16 * (k - 1))) - 1)
            at = np.searchsorted(known[-1], keys & low)  # every suffix is a gram one order below
            lower = prob[-1][at]
            values, weight = np.empty((len(keys), width)), np.ones((len(contexts), width))
            for j, p in enumerate(per_lang):
                (mine, n), (ctx, total, kinds) = p[k]
                w = np.ones(len(contexts))
                w[np.searchsorted(contexts, ctx)] = DISCOUNT * kinds / total
                weight[:, j] = w
                at_ctx = np.searchsorted(contexts, keys >> np.uint64(16))
                values[:, j] = w[at_ctx] * lower[:, j]
                i = np.searchsorted(ctx, mine >> np.uint64(16))
                values[np.searchsorted(keys, mine), j] += np.maximum(n - DISCOUNT, 0) / total[i]
            known.append(keys)
            prob.append(values)
            backoff.append((contexts, weight))
        # the highest order decides most positions; each lower one is asked only where it fails
        self.tables = [HashTable(k, np.log(v)) for k, v in zip(known, prob, strict=True)]
        self.backoff = [HashTable(c, np.log(w)) for c, w in backoff]
        self.unseen = np.log(self.unseen).astype(np.float32)

    @classmethod
    def _orders(cls, keys: np.ndarray, n: np.ndarray) -> dict:
        """By order: ((grams, counts), (contexts, totals, distinct continuations)); below the top, counts are distinct left neighbours."""
        out = {}
        for k in range(ORDER, 0, -1):
            out[k] = cls.order(keys, n)
            if k > 1:
                keys, n = np.unique(keys & np.uint64((1 << (16 * (k - 1))) - 1), return_counts=True)
        return out

    @staticmethod
    def order(keys: np.ndarray, n: np.ndarray) -> tuple:
        ctx, first = np.unique(keys >> np.uint64(16), return_index=True)
        totals = np.add.reduceat(n, first).astype(float) if len(first) else np.zeros(0)
        return (keys, n.astype(float)), (ctx, totals, np.diff(np.append(first, len(keys))).astype(float))

    def log_probs(self, g: np.ndarray) -> np.ndarray:
        """One row per 4-gram, one column per language."""
        out = np.zeros((len(g), len(self.langs)), dtype=np.float32)
        todo = np.arange(len(g))
        for k in range(ORDER, 0, -1):
            low = np.uint64((1 << (16 * k)) - 1) if k < ORDER else ~np.uint64(0)
            key = g[todo] & low
            at = self.tables[k - 1].find(key)
            hit = at >= 0
            out[todo[hit]] += self.tables[k - 1].values[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            if k > 1:
                back = self.backoff[k - 2]
                ctx = back.find(key[~hit] >> np.uint64(16))
                has = ctx >= 0
                out[todo[has]] += back.values[ctx[has]]
        out[todo] += self.unseen
        return out


def _middle(g: np.ndarray) -> np.ndarray:
    """Third letter, then second: what the parts of a model are cut by."""
    return ((g & np.uint64(0xFFFF0000)) | ((g >> np.uint64(32)) & np.uint64(0xFFFF))).astype(np.int64)


class Parts:
    """A model in broadcast parts; part i has the grams whose middle is in [starts[i], starts[i + 1])."""

    def __init__(self, langs: list[str], starts: list[int], shared: list):
        self.langs, self.starts, self.shared = langs, np.array(starts, dtype=np.int64), shared

    def _add(self, g, owner, total, squares=None) -> None:
        part = np.searchsorted(self.starts, _middle(g), side="right") - 1 if len(self.shared) > 1 else None
        step = max(1, AT_ONCE // len(self.langs))
        for i, shared in enumerate(self.shared):
            mine = slice(None) if part is None else np.flatnonzero(part == i)
            grams_, rows = g[mine], owner[mine]
            if not len(grams_):
                continue
            model = shared.value
            for at in range(0, len(grams_), step):
                p = model.log_probs(grams_[at:at + step]).astype(np.float64)
                row = rows[at:at + step]
                first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                total[row[first]] += np.add.reduceat(p, first, axis=0)
                if squares is not None:
                    squares[row[first]] += np.add.reduceat(np.square(p), first, axis=0)
            if part is not None:  # the next part takes its place
                del model
                shared.__dict__.pop("_value", None)

    def blocks(self, texts: list[str | None], window: int = WINDOW, squared: bool = False):
        """(text, letters, sums of log probabilities, of their squares if wanted) of all windows, some texts at a time."""
        held, owners, sizes = [], [], []

        def done():
            n = np.array(sizes)
            total = np.zeros((len(n), len(self.langs)))
            squares = np.zeros((len(n), len(self.langs))) if squared else None
            self._add(np.concatenate(held), np.repeat(np.arange(len(n)), n), total, squares)
            return np.array(owners), n, total, squares

        positions = 0
        for i, text in enumerate(texts):
            for at in range(0, len(text or ""), SLICE):
                code = letters(text[at:at + SLICE])
                if len(code) < 2:
                    continue
                g = grams(code)
                held.append(g)
                # a text's windows are of equal length, the nearest to the wanted one
                parts = max(1, round(len(g) / window))
                cuts = np.arange(parts + 1) * len(g) // parts
                sizes += np.diff(cuts).tolist()
                owners += [i] * parts
                positions += len(g)
                if positions >= HELD:
                    yield done()
                    held, owners, sizes = [], [], []
                    positions = 0
        if held:
            yield done()


def _by_lang(table: pa.Table, langs: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Sorted grams and their counts by language of a table (lang, gram, n)."""
    lang = pc.index_in(table.column("lang"), pa.array(langs)).to_numpy()
    keys, n = table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.lexsort((keys, lang))
    lang, keys, n = lang[order], keys[order], n[order]
    at = np.searchsorted(lang, np.arange(len(langs) + 1))
    return {x: (keys[at[i]:at[i + 1]], n[at[i]:at[i + 1]]) for i, x in enumerate(langs)}


def _starts(counts: DataFrame, room: int) -> list[int]:
    """Where the parts begin: about ``room`` rows each, cut by the third letter and, where one has more, by the second."""
    third = F.shiftrightunsigned("gram", 16).bitwiseAND(0xFFFF)
    pieces = [(r["c"] << 16, r["n"]) for r in counts.groupBy(third.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()]
    large = [key >> 16 for key, n in pieces if n > room]
    if large:
        pieces = [x for x in pieces if x[1] <= room]
        second = F.shiftrightunsigned("gram", 32).bitwiseAND(0xFFFF)
        pieces += [(r["c"] << 16 | r["b"], r["n"]) for r in counts.where(third.isin(large)).groupBy(third.alias("c"), second.alias("b"))
                   .agg(F.count(F.lit(1)).alias("n")).collect()]
    starts, held = [0], 0
    for key, n in sorted(pieces):
        if held and held + n > room:
            starts.append(key)
            held = 0
        held += n
    return starts


def train(texts: DataFrame, max_cells: int = MAX_CELLS) -> Parts | None:
    """A model of all grams of all rows (lang, text); None without any."""
    broadcast = texts.sparkSession.sparkContext.broadcast
    counts = gram_counts(texts.where("lang IS NOT NULL AND text IS NOT NULL")).persist()
    try:
        sizes = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            return None
        langs = sorted(sizes)
        room = max(1, max_cells // len(langs))
        if sum(sizes.values()) <= room:
            return Parts(langs, [0], [broadcast(Model(_by_lang(counts.toArrow(), langs)))])
        starts = _starts(counts, room)
        # the lower orders count neighbours over all parts
        three = counts.select("lang", F.col("gram").bitwiseAND((1 << 48) - 1).alias("gram")).distinct()
        two = three.groupBy("lang", F.col("gram").bitwiseAND((1 << 32) - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")).persist()
        try:
            one = two.groupBy("lang", F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
            first = {x: Model.order(*v) for x, v in _by_lang(one.toArrow(), langs).items()}
            middle = (F.shiftrightunsigned("gram", 16).bitwiseAND(0xFFFF) * 65536 + F.shiftrightunsigned("gram", 32).bitwiseAND(0xFFFF))
            shared = []
            for lo, hi in zip(starts, [*starts[1:], 1 << 32], strict=True):
                mine = _by_lang(counts.where(middle.between(lo, hi - 1)).toArrow(), langs)
                pairs = _by_lang(two.where(F.shiftrightunsigned("gram", 16).between(lo >> 16, (hi - 1) >> 16)).toArrow(), langs)
                shared.append(broadcast(Model(mine, {x: {1: first[x], 2: Model.order(*pairs[x])} for x in langs})))
            return Parts(langs, starts, shared)
        finally:
            two.unpersist()
    finally:
        counts.unpersist()


# --- prediction --------------------------------------------------------------

_SUMS = ("n", "k", "entropy", "entropy2", "square")


def _windows(texts: DataFrame, model: Parts) -> DataFrame:
    """(lang, key, n, k, entropy, entropy2, square): sums over the windows of each text under its own language."""

    def run(batches):
        for batch in slices(batches, "languages"):
            lang = batch.column(0).to_pylist()
            sums = np.zeros((batch.num_rows, 5))
            for owner, n, total, squares in model.blocks(batch.column(2).to_pylist(), squared=True):
                at = np.arange(len(n)), np.array([model.langs.index(lang[i]) for i in owner])
                np.add.at(sums, owner, np.stack([n, np.ones(len(n)), -total[at], total[at] ** 2 / n, squares[at]], axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, sums.T)], names=["lang", "key", *_SUMS])

    return texts.select("lang", "key", "text").mapInArrow(run, "lang string, key long, " + ", ".join(f"{c} double" for c in _SUMS))


def calibrate(texts: DataFrame, model: Parts) -> dict[str, tuple[float, float, float]]:
    """By language: mean entropy, variance between windows, variance of one character.

    From all distinct texts with a letter. Only their sums are shuffled; as
    decimals these add up to the same in any order.
    """
    texts = texts.where(F.col("text").rlike(r"\p{L}")).withColumn("key", F.xxhash64("text"))
    distinct = _windows(texts, model).groupBy("lang", "key").agg(*[F.max(F.col(c).cast("decimal(38,6)")).alias(c) for c in _SUMS])
    found = distinct.groupBy("lang").agg(*[F.sum(c).cast("double").alias(c) for c in _SUMS])
    out = {}
    for r in found.where("n > 0").collect():
        mean = r["entropy"] / r["n"]
        char = max(0.0, (r["square"] - r["entropy2"]) / r["n"])
        # what the length explains is taken off what the windows differ by
        out[r["lang"]] = (mean, max(0.0, r["entropy2"] / r["n"] - mean ** 2 - char * r["k"] / r["n"]), char)
    return out


def _judge(model: Parts, limits: np.ndarray, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: sums of log probabilities per language, letters counted, letters in windows that fit no language."""
    total = np.zeros((len(texts), len(model.langs)))
    count, unfit = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    mean, between, char = limits.T
    for owner, n, sums, _ in model.blocks(texts):
        most = mean + REJECT_Z * np.sqrt(between + char / n[:, None])
        none = (-sums / n[:, None] > most).all(axis=1)
        np.add.at(total, owner, sums)
        np.add.at(count, owner, n)
        np.add.at(unfit, owner, n * none)
    return total, count, unfit


def identify(
    docs: DataFrame,
    train_rows: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    out: tuple[str, str, str] = ("lang_pred", "score", "rejected"),
    max_cells: int = MAX_CELLS,
) -> DataFrame:
    """The documents with predicted language, confidence (0 to 1) and whether they are rejected.

    Only rows where ``train_rows`` holds and whose language isn't null are learned from.
    """
    clash = {x.lower() for x in out} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the input has columns named {sorted(clash)}")
    texts = docs.where(train_rows).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL")
    model = train(texts, max_cells)
    found = calibrate(texts, model) if model else {}
    limits = np.array([found.get(x, (-np.inf, 0.0, 0.0)) for x in model.langs]) if model else None
    schema = StructType([*docs.schema.fields, StructField(out[0], StringType()), StructField(out[1], DoubleType()), StructField(out[2], BooleanType())])
    where = docs.columns.index(text_col)

    def run(batches):
        for batch in slices(batches, "languages"):
            langs, scores, rejected = [], [], []
            total, count, unfit = _judge(model, limits, batch.column(where).to_pylist()) if model else (None, np.zeros(batch.num_rows), None)
            for i, n in enumerate(count):
                if not n:  # no letter
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                entropy = -total[i] / n
                j = int(np.argmin(entropy))
                # what 20 characters of this text say for the language against all
                share = np.exp((entropy[j] - entropy) * min(n, 20))
                langs.append(model.langs[j])
                scores.append(float(1 / share.sum()))
                rejected.append(bool(unfit[i] > REJECT_SHARE * n))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=schema.names)

    return docs.mapInArrow(run, schema)
