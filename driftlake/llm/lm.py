"""Scores of texts by a log-bilinear model, and by word frequencies.

Words are counted over all training documents, whole.  The model's symbols are the
``TOP`` most frequent words, one each, and ``TAIL`` classes that share the rest by hash; a
word's probability is that of its symbol after the two symbols before it, times that of the
word among the words of its class, after the same two.  Both are log-bilinear: the context
symbols' vectors, one table for each position, are added and multiplied with the target's
vector.  Every word of the training documents has a vector, however rare it is.

Corpus statistics (word counts, counts of symbol triples, the contexts of each word) come
from Spark and cover every training document; blocks exchange them as packed keys
(``blocks.py``).  What reaches the driver is bounded by the number of symbols: ``SYMBOLS`` **
3 counts at most.  There the symbols' vectors are fitted in numpy by noise-contrastive
estimation, drawing contexts and targets in proportion to those counts.  The words' vectors
are fitted the same way where their contexts are sent to, in tasks that hold a part of the
words of one class, from all their training tokens.  For scoring, batched products of all
contexts with all targets, symbols and words, give normalised log-probabilities, which
tokens look up; a task adds up its words for each context, and the driver gets the sums.

Defined results: a null text is empty; an empty text has one token, its end.  A null
``doc_id`` is learned from.  Words that no training document has get the share of one
unseen word of their class, whose vector is zero.  A word's product with a context has the
precision of 16 bits.  Repeated rows each get a row.  Other columns are not read.
Without training tokens the model is uniform over symbols.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.blocks import ANSWERED, SENT, SUMMARY, Block, answers, ask, blocked, send
from driftlake.llm.common import given, width, written

#: Symbols: classes of rarer words, then the most frequent words.
TAIL, TOP = 32, 64
SYMBOLS = TAIL + TOP
#: Stands for what is before a text.
BEFORE = SYMBOLS
#: Length of a vector, noise symbols for a batch, contexts in a batch, batches, step size.
SIZE, NOISE, BATCH, STEPS, RATE = 16, 24, 2048, 2500, 0.08
#: For the vectors of words: noise for a token, contexts that stand for noise, steps, and the weight of zero in tokens.
WORD_NOISE, WORD_CONTEXTS, WORD_STEPS, WORD_PRIOR = 4, 128, 6, 10
#: The longest vector of a context that words see; most are about the root of ``SIZE``.
LONGEST = 8
#: Pairs of symbols before a token.
CONTEXTS = (SYMBOLS + 1) ** 2
#: The end of a text; no word has white space in it.
END = xxhash.xxh64_intdigest(b"\n")


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def hashes(text: bytes) -> np.ndarray:
    """The words of a text and its end, as 64-bit hashes."""
    words = text.lower().split()
    words.append(b"\n")
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def tail_class(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(19)) % np.uint64(TAIL)).astype(np.int64)


class Tokens:
    """All tokens of a block: which distinct word each is, where texts begin, what is learned from."""

    def __init__(self, block: Block):
        each = [hashes(text) for text in block.texts]
        self.sizes = np.array([len(x) for x in each], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.held_out = np.array([is_held_out(x) for x in block.doc_ids])
        self.words, self.word = np.unique(np.concatenate(each), return_inverse=True)

    def learned(self) -> np.ndarray:
        return np.repeat(~self.held_out, self.sizes)

    def contexts(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol before each token, and the one before that."""
        one = np.append(BEFORE, symbol[:-1])
        one[self.begins] = BEFORE
        two = np.append(BEFORE, one[:-1])
        two[self.begins] = BEFORE
        return one, two


class Vocabulary:
    """Counts of the training tokens, as far as the model needs them."""

    def __init__(self, classes: list, top: list):
        self.class_tokens, self.class_words = np.zeros(TAIL), np.zeros(TAIL)
        for number, tokens, words in classes:
            self.class_tokens[number], self.class_words[number] = tokens, words
        self.tokens, self.words = int(self.class_tokens.sum()), int(self.class_words.sum())
        self.top = np.array(sorted(key & (2**64 - 1) for key, _ in top), np.uint64)
        for key, count in top:
            number = int(tail_class(np.array([key & (2**64 - 1)], np.uint64))[0])
            self.class_tokens[number] -= count
            self.class_words[number] -= 1

    def symbols(self, words: np.ndarray) -> np.ndarray:
        symbol = tail_class(words)
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, words), len(self.top) - 1)
            symbol = np.where(self.top[at] == words, TAIL + at, symbol)
        return symbol

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))

    def share(self, counts: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 of a word's share of its symbol."""
        number = np.minimum(symbol, TAIL - 1)
        rest = (counts + 0.5) / (self.class_tokens[number] + 0.5 * (self.class_words[number] + 1))
        return np.where(symbol < TAIL, np.log10(rest), 0.0)

    def class_sums(self, sums) -> np.ndarray:
        """log10 of what all words of a class, an unseen one too, add up to in each context."""
        whole = np.full((TAIL, CONTEXTS), np.log(0.5))
        for number, total in sums:
            whole[number] = np.logaddexp(whole[number], total)
        return (whole - np.log(self.class_tokens + 0.5 * (self.class_words + 1))[:, None]) / np.log(10)


def places(own: Tokens, symbol: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens in classes, and the pairs of a word and a context that they are.

    Which tokens; which pair each is; the pairs, word * ``CONTEXTS`` + context; the bucket of
    each.  A bucket has words of one class only, a class has ``parts`` of them.
    """
    one, two = own.contexts(symbol[own.word])
    tail = np.flatnonzero(symbol[own.word] < TAIL)
    pairs = own.word[tail] * CONTEXTS + (two * (SYMBOLS + 1) + one)[tail]
    pairs, each = np.unique(pairs, return_inverse=True)
    bucket = tail_class(own.words) * parts + ((own.words >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)
    return tail, each, pairs, bucket[pairs // CONTEXTS]


class LogBilinear:
    """Vectors of targets and of contexts at two positions, and a bias for each target."""

    def __init__(self, seed: int = 1):
        draw = np.random.default_rng(seed)
        self.first = draw.normal(0, 0.05, (SYMBOLS + 1, SIZE))
        self.second = draw.normal(0, 0.05, (SYMBOLS + 1, SIZE))
        self.target = draw.normal(0, 0.05, (SYMBOLS, SIZE))
        self.bias = np.zeros(SYMBOLS)

    def contexts(self) -> np.ndarray:
        """The vector of each pair of symbols, the one two before first."""
        return (self.second[:, None, :] + self.first[None, :, :]).reshape(-1, SIZE)

    def table(self) -> np.ndarray:
        """log10 probabilities, indexed by the symbols two before and one before, and the target."""
        logits = self.contexts() @ self.target.T + self.bias
        logits -= logits.max(axis=1, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return (logits / np.log(10)).reshape(SYMBOLS + 1, SYMBOLS + 1, SYMBOLS)

    def fit(self, codes: np.ndarray, counts: np.ndarray, steps: int = STEPS, seed: int = 2) -> "LogBilinear":
        """Noise-contrastive estimation with Adagrad; noise has the targets' frequencies."""
        if not len(codes):
            return self
        draw = np.random.default_rng(seed)
        ends = np.cumsum(counts)
        target, before = codes % SYMBOLS, codes // SYMBOLS
        noise_share = np.bincount(target, weights=counts, minlength=SYMBOLS) + 0.5
        noise_share /= noise_share.sum()
        self.bias = np.log(noise_share)
        handicap = np.log(NOISE * noise_share)
        tables = (self.first, self.second, self.target, self.bias)
        squares = [np.full_like(x, 1e-3) for x in tables]
        for _ in range(steps):
            row = np.searchsorted(ends, draw.random(BATCH) * ends[-1], side="right")
            y, one, two = target[row], before[row] % (SYMBOLS + 1), before[row] // (SYMBOLS + 1)
            noise = draw.choice(SYMBOLS, NOISE, p=noise_share)
            context = self.first[one] + self.second[two]
            true = (context * self.target[y]).sum(axis=1) + self.bias[y] - handicap[y]
            false = context @ self.target[noise].T + self.bias[noise] - handicap[noise]
            up = 1 / (1 + np.exp(true)) / BATCH
            down = -1 / (1 + np.exp(-false)) / BATCH
            toward = up[:, None] * self.target[y] + down @ self.target[noise]
            grads = [np.zeros_like(x) for x in tables]
            np.add.at(grads[0], one, toward)
            np.add.at(grads[1], two, toward)
            np.add.at(grads[2], y, up[:, None] * context)
            np.add.at(grads[2], noise, down.T @ context)
            np.add.at(grads[3], y, up)
            np.add.at(grads[3], noise, down.sum(axis=0))
            for table, grad, square in zip(tables, grads, squares):
                square += grad * grad
                table += RATE * grad / np.sqrt(square)
        return self


class WordVectors:
    """Vectors of words as targets within their class, ahead of their shares.

    ``around`` has the context vectors, shifted and turned so that over the training tokens of
    all classes they have mean zero, variance one and no correlation; the length of those that
    are rare among them is at most ``LONGEST``.
    """

    def __init__(self, model: LogBilinear, codes: np.ndarray, counts: np.ndarray):
        tail = codes % SYMBOLS < TAIL
        often = np.bincount(codes[tail] // SYMBOLS, weights=counts[tail], minlength=CONTEXTS)
        if not often.sum():
            often = np.ones(CONTEXTS)
        often /= often.sum()
        around = model.contexts()
        around -= often @ around
        spread, turn = np.linalg.eigh((around * often[:, None]).T @ around)
        around = around @ (turn / np.sqrt(np.maximum(spread, 1e-3 * spread.max() + 1e-9)))
        around /= np.maximum(np.sqrt((around**2).sum(axis=1, keepdims=True)) / LONGEST, 1)
        self.around = around.astype(np.float32)
        middles = (np.arange(WORD_CONTEXTS) + 0.5) / WORD_CONTEXTS
        at = np.minimum(np.searchsorted(np.cumsum(often), middles), CONTEXTS - 1)
        self.noise = self.around[at]

    def of_words(
        self, word: np.ndarray, code: np.ndarray, count: np.ndarray, words: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which vector each word has, the vectors, and the smoothed counts of their words.

        Words with one training token share a vector if they have it in the same context, as
        theirs would be equal.  The last vector is zero, for words without any.
        """
        seen = np.flatnonzero(count)
        keys, each = np.unique(word[seen].astype(np.int64) * CONTEXTS + code[seen], return_inverse=True)
        count = np.bincount(each, weights=count[seen], minlength=len(keys)).astype(np.int64)
        word, code = keys // CONTEXTS, keys % CONTEXTS
        tokens = np.bincount(word, weights=count, minlength=words)
        lone = tokens[word] == 1
        alike, same, times = np.unique(code[lone], return_inverse=True, return_counts=True)
        begins = np.flatnonzero(np.diff(word[~lone], prepend=-1))
        many = word[~lone][begins]
        which = np.full(words, len(many) + len(alike))
        which[many] = np.arange(len(many))
        which[word[lone]] = len(many) + same
        begins = np.concatenate([begins, np.count_nonzero(~lone) + np.arange(len(alike))])
        code, count = np.concatenate([code[~lone], alike]), np.concatenate([count[~lone], np.ones(len(alike), np.int64)])
        vectors = np.concatenate([self.fit(code, count, begins), np.zeros((1, SIZE), np.float32)])
        return which, vectors, np.concatenate([tokens[many] + 0.5, 1.5 * times])

    def fit(self, code: np.ndarray, count: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """A vector for each run of contexts and counts; the runs start at ``begins``."""
        pieces = np.unique(np.searchsorted(begins, np.arange(0, len(code), 1 << 16)))
        pieces = pieces[pieces < len(begins)]
        fitted = [np.empty((0, SIZE), np.float32)]
        for first, last in zip(pieces, [*pieces[1:], len(begins)]):
            end = begins[last] if last < len(begins) else len(code)
            own = slice(begins[first], end)
            fitted.append(self._fit(code[own], count[own].astype(np.float32), begins[first:last] - begins[first]))
        return np.concatenate(fitted)

    def _fit(self, code: np.ndarray, count: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Noise-contrastive estimation; noise has a word as often as its share in any context.

        Each word's objective is concave; a step that would lower it is taken back and shortened.
        """
        context = self.around[code]
        each = np.repeat(np.arange(len(begins)), np.diff(begins, append=len(code)))
        tokens = np.add.reduceat(count, begins)
        noise, handicap = tokens * np.float32(WORD_NOISE / WORD_CONTEXTS), np.float32(np.log(WORD_NOISE))
        length = tokens * np.float32((1 + WORD_NOISE) / 4) + np.float32(WORD_PRIOR)
        tried = np.zeros((len(begins), SIZE), np.float32)
        best, slope, top = tried.copy(), tried.copy(), np.full(len(begins), -np.inf, np.float32)
        for _ in range(WORD_STEPS):
            true = np.exp(handicap - np.einsum("ij,ij->i", context, tried[each]))
            false = np.exp(tried @ self.noise.T - handicap)
            value = -np.add.reduceat(count * np.log(1 + true), begins) - noise * np.log(1 + false).sum(axis=1)
            value -= np.float32(WORD_PRIOR / 2) * (tried**2).sum(axis=1)
            up = np.add.reduceat(context * (count * true / (1 + true))[:, None], begins, axis=0)
            down = (false / (1 + false)) @ self.noise * noise[:, None]
            better = value > top
            best[better], top[better] = tried[better], value[better]
            slope[better] = (up - down - np.float32(WORD_PRIOR) * tried)[better]
            length[~better] *= 4
            tried = best + slope / length[:, None]
        return best

    def products(self, vectors: np.ndarray, word: np.ndarray, code: np.ndarray) -> np.ndarray:
        """log10 of how much likelier than its share each word is in its context, but for ``sums``."""
        pieces = range(0, len(word), 1 << 16)
        dots = [np.einsum("ij,ij->i", vectors[word[i : i + (1 << 16)]], self.around[code[i : i + (1 << 16)]]) for i in pieces]
        return (np.concatenate([np.empty(0, np.float32), *dots]) / np.float32(np.log(10))).astype(np.float16)

    def sums(self, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Logarithm of what the weights times the exponentials of products add up to in each context."""
        total, scale = np.full(CONTEXTS, -np.inf), np.log(weights).astype(np.float32)
        for i in range(0, len(vectors), 128):
            each = vectors[i : i + 128] @ self.around.T
            each += scale[i : i + 128, None]
            most = each.max(axis=0)
            sums = np.log(np.exp(np.subtract(each, most, out=each), out=each).sum(axis=0)) + most
            total = np.logaddexp(total, sums)
        return total


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next; small numbers pack well."""
    return numbers.view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _packed(words: np.ndarray, sizes: np.ndarray, code: np.ndarray, count: np.ndarray) -> bytes:
    """Words, how many contexts each has, and for each context how many training tokens."""
    head = np.array([len(words), len(code)], np.int64).tobytes()
    return head + words.tobytes() + _planes(sizes.astype(np.uint32)) + _planes(code.astype(np.uint16)) + _planes(count)


def _opened(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words, pairs = np.frombuffer(data, np.int64, 2)
    kinds = ((words, np.uint64), (words, np.uint32), (pairs, np.uint16), (pairs, np.uint32))
    columns, at = [], 16
    for number, kind in kinds:
        size = np.dtype(kind).itemsize
        own = np.frombuffer(data, np.uint8, number * size, at)
        at += number * size
        if kind != np.uint64:
            own = own.reshape(size, number).T.copy()
        columns.append(own.view(kind).reshape(-1))
    return tuple(columns)


def _halves(keys: np.ndarray) -> list[np.ndarray]:
    return [(keys >> np.uint64(32)).astype(np.uint32), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)]


def _summed(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of a bucket, which of them each sent key is, and their counts."""
    high, low, count = np.concatenate(columns, axis=1)
    keys, each = np.unique(high.astype(np.uint64) << np.uint64(32) | low, return_inverse=True)
    return keys, each, np.bincount(each, weights=count).astype(np.int64)


def _reply(columns: list[np.ndarray], parts: np.ndarray) -> list[np.ndarray]:
    _, each, counts = _summed(columns)
    return np.split(counts[each], np.cumsum([c.shape[1] for c in columns])[:-1])


def _summary(columns: list[np.ndarray]) -> bytes:
    """Tokens and words of each class, then the most frequent keys with their counts."""
    keys, _, counts = _summed(columns)
    number = tail_class(keys)
    tokens = np.bincount(number, weights=counts, minlength=TAIL).astype(np.int64)
    words = np.bincount(number, weights=counts > 0, minlength=TAIL).astype(np.int64)
    top = np.lexsort((keys, -counts))[:TOP]
    top = top[counts[top] > 0]
    return b"".join(x.tobytes() for x in (tokens, words, keys[top].view(np.int64), counts[top]))


def _unpacked(batches):
    for batch in batches:
        for data in batch["data"]:
            numbers = np.frombuffer(data, np.int64)
            tokens, words, rest = numbers[:TAIL], numbers[TAIL : 2 * TAIL], numbers[2 * TAIL :].reshape(2, -1)
            rows = [("class", i, tokens[i], words[i]) for i in range(TAIL)]
            rows += [("top", key, count, 1) for key, count in rest.T]
            yield pd.DataFrame(rows, columns=["kind", "id", "n", "words"])


def vocabulary(summaries: DataFrame) -> Vocabulary:
    rows = summaries.select("data").mapInPandas(_unpacked, "kind string, id long, n long, words long")
    rows = written(rows, "lm-summary")
    classes = rows.filter("kind = 'class'").groupBy("id").agg(F.sum("n"), F.sum("words")).collect()
    top = rows.filter("kind = 'top'").orderBy(F.desc("n"), "id").limit(TOP).select("id", "n").collect()
    return Vocabulary([tuple(row) for row in classes], [tuple(row) for row in top])


RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score_texts(docs: DataFrame) -> DataFrame:
    """Count, fit and score; a row of ``RESULT`` for every row of ``docs``."""
    table, buckets = blocked(docs), width(docs.sparkSession)

    def send_counts(rows: pa.Table) -> pa.Table:
        block = Block(rows)
        own = Tokens(block)
        counts = np.bincount(own.word, weights=own.learned(), minlength=len(own.words)).astype(np.uint32)
        return send(block, own.words, [*_halves(own.words), counts], buckets)

    sent = table.groupBy("block").applyInArrow(send_counts, SENT)
    told = ask(sent, "counts", _reply, 3, _summary)
    known = vocabulary(told.filter(F.col("kind") == SUMMARY))

    def send_triples(rows: pa.Table) -> pa.Table:
        block = Block(rows)
        own = Tokens(block)
        symbol = known.symbols(own.words)[own.word]
        one, two = own.contexts(symbol)
        code = ((two * (SYMBOLS + 1) + one) * SYMBOLS + symbol)[own.learned()]
        codes, counts = np.unique(code, return_counts=True)
        keys = codes.astype(np.uint64)
        return send(block, keys, [codes.astype(np.uint32), counts.astype(np.uint32)], buckets)

    def add_triples(rows: pa.Table) -> pa.Table:
        columns = [np.frombuffer(data, np.uint32).reshape(2, -1) for data in rows["data"].to_pylist()]
        code, count = np.concatenate(columns, axis=1)
        codes, each = np.unique(code, return_inverse=True)
        sums = np.bincount(each, weights=count).astype(np.int64)
        return pa.table({"data": pa.array([codes.astype(np.int64).tobytes() + sums.tobytes()], pa.binary())})

    sent = table.groupBy("block").applyInArrow(send_triples, SENT)
    sums = written(sent.groupBy("bucket").applyInArrow(add_triples, "data binary"), "lm-triples")
    pieces = [np.frombuffer(row["data"], np.int64).reshape(2, -1) for row in sums.toLocalIterator()]
    codes, counts = np.concatenate([np.empty((2, 0), np.int64), *pieces], axis=1)
    order = np.argsort(codes)  # rows come in any order; the draw must not depend on it
    model = LogBilinear().fit(codes[order], counts[order])

    vectors, parts = WordVectors(model, codes[order], counts[order]), -(-buckets // TAIL)

    def send_places(rows: pa.Table) -> pa.Table:
        block = Block(rows)
        own = Tokens(block)
        tail, each, pairs, bucket = places(own, known.symbols(own.words), parts)
        count = np.bincount(each, weights=own.learned()[tail], minlength=len(pairs)).astype(np.uint32)
        order = np.argsort(bucket, kind="stable")
        made = []
        for piece in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            if len(piece):
                word, sizes = np.unique(pairs[piece] // CONTEXTS, return_counts=True)
                data = _packed(own.words[word], sizes, pairs[piece] % CONTEXTS, count[piece])
                made.append((int(bucket[piece[0]]), block.block, block.part, data))
        columns = zip(*made) if made else [()] * 4
        kinds = {"bucket": pa.int32(), "block": pa.int64(), "part": pa.int32(), "data": pa.binary()}
        return pa.table({name: pa.array(x, kind) for x, (name, kind) in zip(columns, kinds.items())})

    def fit_words(rows: pa.Table) -> pa.Table:
        sent = [_opened(data) for data in rows["data"].to_pylist()]
        all_words, sizes, code, count = (np.concatenate(x) for x in zip(*sent))
        words, each = np.unique(all_words, return_inverse=True)
        word = np.repeat(each, sizes)
        which, fitted, weights = vectors.of_words(word, code, count, len(words))
        products = vectors.products(fitted, which[word], code)
        replies = [x.tobytes() for x in np.split(products, np.cumsum([len(x[2]) for x in sent])[:-1])]
        total = vectors.sums(fitted[:-1], weights).tobytes()
        return pa.table(
            {
                "block": pa.array([*rows["block"].to_pylist(), -1], pa.int64()),
                "bucket": pa.array([rows["bucket"][0].as_py()] * (len(sent) + 1), pa.int32()),
                "kind": pa.array(["places"] * len(sent) + [SUMMARY], pa.string()),
                "data": pa.array([*replies, total], pa.binary()),
            }
        )

    sent = table.groupBy("block").applyInArrow(send_places, SENT)
    placed = written(sent.groupBy("bucket").applyInArrow(fit_words, ANSWERED), "lm-places")
    whole = known.class_sums(
        (row["bucket"] // parts, np.frombuffer(row["data"]))
        for row in placed.filter(F.col("kind") == SUMMARY).orderBy("bucket").toLocalIterator()
    )

    def score(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(rows)
        own = Tokens(block)
        counts = answers(replies, "counts", own.words, buckets, np.int64)
        symbol = known.symbols(own.words)
        base, share = known.base(counts), known.share(counts, symbol)
        one, two = own.contexts(symbol[own.word])
        token = model.table()[two, one, symbol[own.word]] + share[own.word]
        tail, each, pairs, bucket = places(own, symbol, parts)
        found = [(b, d) for b, k, d in zip(*(replies[c].to_pylist() for c in ("bucket", "kind", "data"))) if k == "places"]
        found = np.frombuffer(b"".join(data for _, data in sorted(found)), np.float16)
        if len(found) != len(pairs):
            raise ValueError("a block got another number of products than it sent contexts")
        ahead = np.empty(len(pairs))
        ahead[np.argsort(bucket, kind="stable")] = found
        ahead -= whole[bucket // parts, pairs % CONTEXTS]
        token[tail] += ahead[each]

        def total(values: np.ndarray) -> np.ndarray:
            return np.add.reduceat(values, own.begins)

        return pa.table(
            {
                "doc_id": pa.array(block.doc_ids, pa.int64()),
                "held_out": pa.array(own.held_out),
                "n_tokens": pa.array(own.sizes),
                "n_known": pa.array(total((counts > 0).astype(np.int64)[own.word])),
                "train_tokens": pa.array(np.full(len(own.sizes), known.tokens, np.int64)),
                "base_score": pa.array(total(base[own.word])),
                "score": pa.array(total(token)),
            }
        )

    replies = told.unionByName(placed).filter(F.col("kind") != SUMMARY)
    return table.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, RESULT)


def op4_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(given(spark, folder, "documents"))
