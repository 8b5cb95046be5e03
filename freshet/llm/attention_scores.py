"""Language-model scores by a causal self-attention model trained in numpy on subword ids.

A text is its words (A-Z in lower case, runs of anything but ASCII white space), each encoded into subword ids, and one
end. Subwords are grouped into classes, classes into groups. From the last ``WINDOW`` subwords the model predicts the next
one's group, and its class within the group, by masked self-attention, and the subword within its class by its frequency in
the corpus. Long texts are read in windows that overlap by ``WINDOW - STRIDE``; each subword is scored once, in the window
that gives it the longest context.

Frequencies, what stands beside each subword (its class comes from that) and pairs of classes are counted over all training
texts. The network is trained in ``ROUNDS`` rounds: each partition of the training texts goes on from the same weights with
the windows of its own texts, at least ``LEAST_STEPS`` batches a round, and the weights are averaged by the number of windows.
Every window of every training text is gone through: in one of the rounds, or in all where a partition has few. 
Each task reads its texts in chunks of bounded size. A chunk lists its distinct words, and each of its texts becomes the
places of its words in that list; the texts themselves are not read or moved again. The lists go to buckets by their words'
hash: one row of words a chunk and bucket, so that no word is a hot key and buckets have bounded size. There each word is
counted over all chunks and encoded once, and count and ids go back to the chunks. Each text's subword ids are written once;
counting, training and scoring read them.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.columns import text_or_empty
from freshet.llm.tokens import pieces_of
from freshet.session import released, shuffle_files_removed, stored

WINDOW, STRIDE, WIDTH = 32, 24, 16
BEGIN, END = 1, 2
CLASSES, SINGLES, CONTEXT = 256, 200, 256
GROUPS = 16
MEMBERS = CLASSES // GROUPS
CHUNK_BYTES = 16_000_000
SLICE, WORDS_AT_ONCE = 64, 4_096
#: A partition takes at least so many steps a round; where it has windows for more, batches grow first.
ROUNDS, LEAST_STEPS, BATCH, LARGEST_BATCH = 4, 250, 32, 512
#: So many subwords are held at a time in training, and their windows gone through.
HELD = 4_000_000
#: So many windows' gradients are worked out at a time.
AT_ONCE = 256
#: So many weights are changed at a time.
CELLS_AT_ONCE = 8_192
#: The weights are averaged in so many pieces.
PIECES = 64


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of each text, and an empty one as its end."""
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    # A separator after the last word makes an empty string follow it.
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(plain, ""), "", pc.binary_join_element_wise(plain, "", " ")))


@dataclass(frozen=True)
class Weights:
    """Class of each subword, log10 of its share in the class, and the network."""

    classes: np.ndarray
    shares: np.ndarray
    net: dict[str, np.ndarray]


def windows(lines: list[np.ndarray], own: slice = slice(None)) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (window, WINDOW), targets (window, STRIDE; -1 where there is none) and text number of the ``own`` windows."""
    ahead = WINDOW - STRIDE
    counts = np.array([-(-len(x) // STRIDE) for x in lines], np.int64)
    starts = np.append(0, np.cumsum(counts * STRIDE + ahead))
    inputs, targets = np.full(starts[-1] + 1, BEGIN, np.int32), np.full(starts[-1] + 1, -1, np.int32)
    for at, ids in zip(starts, lines):
        inputs[at + ahead + 1 : at + ahead + len(ids)] = ids[:-1]
        targets[at + ahead : at + ahead + len(ids)] = ids
    owner = np.repeat(np.arange(len(lines)), counts)
    first = starts[owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    place = first[own, None] + np.arange(WINDOW)
    return inputs[place], targets[place[:, ahead:]], owner[own]


#: The places of a window that are scored.
SCORED = slice(WINDOW - STRIDE, WINDOW)
#: Of each scored place and each place: 40, so that no exponential overflows, or what makes the weight of a later place 0.
LIMIT = np.where(np.tril(np.ones((WINDOW, WINDOW))), 40, -np.inf).astype(np.float32)[SCORED]


def attended(net: dict[str, np.ndarray], seen: np.ndarray) -> tuple:
    """The hidden state of the last STRIDE places of each window, and what the gradients need.

    Keys and values are as wide as places, so query and key are multiplied first, and value and back.
    """
    x = net["embed"].take(seen, axis=0)
    x += net["place"]
    own = x[:, SCORED].reshape(-1, WIDTH)
    turned = np.ascontiguousarray(x.transpose(0, 2, 1))  # small products with a turned view take three times as long
    q = (own @ (net["query"] @ net["key"].T)).reshape(-1, STRIDE, WIDTH)
    weight = np.matmul(q, turned)
    np.minimum(weight, LIMIT, out=weight)
    np.exp(weight, out=weight)
    total = _row_sums(weight.reshape(-1, WINDOW)).reshape(-1, STRIDE, 1)
    mixed = np.matmul(weight, x)
    mixed /= total
    hidden = mixed.reshape(-1, WIDTH) @ (net["value"] @ net["back"])
    hidden += own
    return hidden, (x, own, turned, q, weight, total, mixed)


def _row_sums(table: np.ndarray) -> np.ndarray:
    return table @ np.ones(table.shape[-1], table.dtype)


@functools.lru_cache
def _cells(size: int, width: int) -> np.ndarray:
    return np.arange(size * width).reshape(size, width)


def _add_rows(total: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add to ``total`` each of ``values`` at its number in ``rows``."""
    np.add.at(total.reshape(-1), _cells(*total.shape).take(rows, axis=0).ravel(), values.ravel())


def levels(net: dict[str, np.ndarray], hidden: np.ndarray, before: np.ndarray, wanted: np.ndarray) -> tuple:
    """Logits of every group of classes, and of the members of the wanted class's group, in the order of that group.

    Returns that order, where each group begins, hidden in it, the class before, the row of ``pairs``, and both logits.
    """
    group = (wanted // MEMBERS).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    hidden, before, group = hidden.take(order, axis=0), before.take(order), group.take(order)
    edges = np.searchsorted(group, np.arange(GROUPS + 1))
    row = group * np.int64(CLASSES) + before
    first = hidden @ net["groups"]
    first += net["group_pairs"].take(before, axis=0)
    second = np.empty((len(hidden), MEMBERS), hidden.dtype)
    for g in range(GROUPS):
        own = slice(edges[g], edges[g + 1])
        np.matmul(hidden[own], net["members"][g], out=second[own])
    second += net["pairs"].take(row, axis=0)
    for logits in (first, second):
        np.clip(logits, -60, 60, out=logits)
    return order, edges, hidden, before, row, first, second


def class_log_probability(net: dict[str, np.ndarray], seen: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log P of the wanted class at the last STRIDE places of each window: its group's, and its share in the group."""
    hidden, _ = attended(net, seen)
    before, wanted = seen[:, SCORED].ravel(), wanted.ravel()
    order, _, _, _, _, first, second = levels(net, hidden, before, wanted)
    at, wanted = np.arange(len(order)), wanted.take(order)
    found = first.take(at * GROUPS + wanted // MEMBERS) + second.take(at * MEMBERS + wanted % MEMBERS)
    for logits in (first, second):
        np.exp(logits, out=logits)
        found -= np.log(_row_sums(logits))
    result = np.empty(len(order), np.float32)
    result[order] = found
    return result.reshape(len(seen), STRIDE)


def _gradients(net: dict[str, np.ndarray], seen: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
    grads = {name: np.zeros_like(w) for name, w in net.items()}
    _add_gradients(grads, net, seen, wanted)
    return grads


def _add_gradients(grads: dict[str, np.ndarray], net: dict[str, np.ndarray], seen: np.ndarray, wanted: np.ndarray) -> None:
    """Add the batch's gradients to ``grads``, ``AT_ONCE`` windows at a time, whose tables stay in a core's cache."""
    share = net["embed"].dtype.type(1 / max(1, np.count_nonzero(wanted >= 0)))
    for at in range(0, len(seen), AT_ONCE):
        _add_part(grads, net, seen[at : at + AT_ONCE], wanted[at : at + AT_ONCE].ravel(), share)


def _add_part(grads: dict[str, np.ndarray], net: dict[str, np.ndarray], seen: np.ndarray, wanted: np.ndarray, share) -> None:
    hidden, (x, own, turned, q, weight, total, mixed) = attended(net, seen)
    flat = lambda a: a.reshape(-1, a.shape[-1])
    order, edges, hidden, before, row, first, second = levels(net, hidden, seen[:, SCORED].ravel(), np.maximum(wanted, 0))
    wanted = wanted.take(order)
    each, want, at = (wanted >= 0) * share, np.maximum(wanted, 0), np.arange(len(order))
    for logits, one in ((first, want // MEMBERS), (second, want % MEMBERS)):
        np.exp(logits, out=logits)
        logits *= (each / _row_sums(logits))[:, None]
        logits.reshape(-1)[at * logits.shape[1] + one] -= each
    _add_rows(grads["group_pairs"], before, first)
    _add_rows(grads["pairs"], row, second)
    grads["groups"] += hidden.T @ first
    d_sorted = np.empty_like(hidden)
    for g in range(GROUPS):
        part = slice(edges[g], edges[g + 1])
        grads["members"][g] += hidden[part].T @ second[part]
        np.matmul(second[part], net["members"][g].T, out=d_sorted[part])
    d_sorted += first @ net["groups"].T
    back = np.empty_like(order)
    back[order] = at
    d_hidden = d_sorted.take(back, axis=0)
    d_product = flat(mixed).T @ d_hidden
    grads["value"] += d_product @ net["back"].T
    grads["back"] += net["value"].T @ d_product
    d_mixed = (d_hidden @ (net["value"] @ net["back"]).T).reshape(mixed.shape)
    d_mixed /= total
    d_score = np.matmul(d_mixed, turned)
    mixed *= d_mixed
    d_score -= _row_sums(flat(mixed)).reshape(total.shape)
    d_score *= weight
    d_x = np.matmul(weight.transpose(0, 2, 1), d_mixed)
    d_x += np.matmul(d_score.transpose(0, 2, 1), q)
    d_q = flat(np.matmul(d_score, x))
    d_product = own.T @ d_q
    grads["query"] += d_product @ net["key"]
    grads["key"] += d_product.T @ net["query"]
    d_hidden += d_q @ (net["key"] @ net["query"].T)
    d_x[:, SCORED] += d_hidden.reshape(q.shape)
    grads["place"] += (np.ones(len(d_x), d_x.dtype) @ d_x.reshape(len(d_x), -1)).reshape(WINDOW, WIDTH)
    _add_rows(grads["embed"], seen.ravel(), flat(d_x))


@dataclass(frozen=True)
class Places:
    """From counts of subwords: classes of those that stand alone, the others by count, and rows and columns of neighbour counts."""

    table: np.ndarray
    rest: np.ndarray
    row: np.ndarray
    column: np.ndarray


def _places(counts: np.ndarray) -> Places:
    vocabulary = len(counts)
    by_count = np.argsort(-counts, kind="stable")
    table = np.full(vocabulary, CLASSES - 1)
    seen = by_count[counts[by_count] > 0]
    table[seen[:SINGLES]] = np.arange(min(SINGLES, len(seen)))
    rest = seen[SINGLES:]
    column = np.full(vocabulary, -1)
    column[by_count[:CONTEXT]] = np.arange(min(CONTEXT, vocabulary))
    row = np.full(vocabulary, -1)
    row[rest] = np.arange(len(rest))
    return Places(table, rest, row, column)


def _add_neighbours(total: np.ndarray, lines: list[np.ndarray], places: Places) -> None:
    """Count in ``total`` (len(rest), 2 * CONTEXT) which frequent subwords stand after and before each of the rest."""
    row, column = places.row, places.column
    left, right = np.concatenate([x[:-1] for x in lines]), np.concatenate([x[1:] for x in lines])
    for here, there, shift in ((left, right, 0), (right, left, CONTEXT)):
        good = np.flatnonzero((row.take(here) >= 0) & (column.take(there) >= 0))
        cell = row.take(here.take(good)) * total.shape[1] + (column.take(there.take(good)) + shift)
        np.add.at(total.reshape(-1), cell, np.ones(len(cell), total.dtype))


def _class_table(places: Places, neighbours: np.ndarray | None) -> np.ndarray:
    """Classes: frequent subwords alone, the others by k-means over their neighbours, unseen ones last."""
    table, rest = places.table.copy(), places.rest
    groups = CLASSES - 1 - SINGLES
    if len(rest) <= groups:
        table[rest] = SINGLES + np.arange(len(rest))
        return table
    table_of = neighbours.astype(np.float32)
    table_of = np.sqrt(table_of / np.maximum(table_of.sum(axis=1, keepdims=True), 1))
    centres = table_of[np.linspace(0, len(rest) - 1, groups).astype(int)].copy()
    for _ in range(12):
        near = np.argmax(2 * table_of @ centres.T - (centres**2).sum(axis=1), axis=1)
        for g in range(groups):
            if (near == g).any():
                centres[g] = table_of[near == g].mean(axis=0)
    table[rest] = SINGLES + near
    return table


def class_table(lines: list[np.ndarray], vocabulary: int) -> np.ndarray:
    """The class of each subword from texts of ids held in memory."""
    places = _places(np.bincount(np.concatenate([np.zeros(0, np.int64), *lines]), minlength=vocabulary))
    neighbours = np.zeros((len(places.rest), 2 * CONTEXT), np.int32)
    if lines:
        _add_neighbours(neighbours, lines, places)
    return _class_table(places, neighbours)


def _class_pairs(lines: list[np.ndarray], classes: np.ndarray) -> np.ndarray:
    """How often each class follows each, the beginning of a text included."""
    before = [np.append(BEGIN, x[:-1]) for x in lines]
    cell = classes[np.concatenate(before)] * CLASSES + classes[np.concatenate(lines)] if lines else np.zeros(0, np.int64)
    return np.bincount(cell, minlength=CLASSES * CLASSES)


def started(pairs: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights before training: drawn ones, and pairs of classes from their counts."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    net = {"embed": draw(CLASSES, WIDTH) * 5, "place": draw(WINDOW, WIDTH)}
    net |= {"groups": draw(WIDTH, GROUPS), "members": draw(GROUPS, WIDTH, MEMBERS)}
    net |= {name: draw(WIDTH, WIDTH) * 2 for name in ("query", "key", "value", "back")}
    pairs = (pairs + 0.5).reshape(CLASSES, GROUPS, MEMBERS)
    of_group = pairs.sum(axis=2)
    net["group_pairs"] = np.log(of_group / of_group.sum(axis=1, keepdims=True)).astype(np.float32)
    # Rows of one group lie together, as the gradients go group by group.
    net["pairs"] = np.log(pairs / of_group[:, :, None]).transpose(1, 0, 2).reshape(-1, MEMBERS).astype(np.float32)
    return net


def stepped(
    net: dict[str, np.ndarray], lines: list[np.ndarray], classes: np.ndarray, steps: int, batch: int, seed, done: float = 0, upto: float = 1
) -> dict[str, np.ndarray]:
    """Weights after ``steps`` of Adam on windows of the texts, while training goes from the share ``done`` to ``upto``.

    The windows are dealt in random order, each once before any comes again.
    """
    inputs, targets, _ = windows(lines)
    return _stepped(net, inputs, targets, classes, steps, batch, seed, done, upto)


def _stepped(net: dict, inputs: np.ndarray, targets: np.ndarray, classes: np.ndarray, steps: int, batch: int, seed, done: float, upto: float) -> dict:
    rng = np.random.default_rng(seed)
    passes = -(-steps * batch // len(inputs))
    order = np.concatenate([rng.permutation(len(inputs)) for _ in range(passes)])
    seen, wanted = _classes_of(inputs, targets, classes)
    flat = np.concatenate([w.ravel() for w in net.values()]).astype(np.float32)
    grad, mean, square = np.zeros_like(flat), np.zeros_like(flat), np.zeros_like(flat)
    edges = np.cumsum([w.size for w in net.values()])[:-1]
    net, grads = ({n: x.reshape(w.shape) for (n, w), x in zip(net.items(), np.split(of, edges))} for of in (flat, grad))
    slow = np.concatenate([np.full(w.size, 0.1 if n.endswith("pairs") else 1, np.float32) for n, w in net.items()])
    parts = [slice(at, at + CELLS_AT_ONCE) for at in range(0, len(flat), CELLS_AT_ONCE)]
    for step in range(1, steps + 1):
        own = order[(step - 1) * batch : step * batch]
        rate = 0.01 * min(1, step / 20) * (1 - 0.9 * (done + (upto - done) * step / steps))
        grad.fill(0)
        _add_gradients(grads, net, seen.take(own, axis=0).astype(np.int64), wanted.take(own, axis=0).astype(np.int64))
        # ``mean`` and ``square`` are kept 10 and 100 times as large as Adam's.
        larger = np.sqrt(0.01 / (1 - 0.99**step))
        factor, least = np.float32(0.1 * rate / (1 - 0.9**step) / larger), np.float32(1e-8 / larger)
        for part in parts:
            g, m, v = grad[part], mean[part], square[part]
            m *= np.float32(0.9)
            m += g
            g *= g
            v *= np.float32(0.99)
            v += g
            np.sqrt(v, out=g)
            g += least
            np.divide(m, g, out=g)
            g *= slow[part]
            g *= factor
            flat[part] -= g
    return net


def _classes_of(inputs: np.ndarray, targets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of inputs and targets in few bytes; -1 where there is no target."""
    wanted = classes.astype(np.int16).take(targets, mode="clip")
    wanted[targets < 0] = -1
    return classes.astype(np.uint8).take(inputs), wanted


def trained(lines: list[np.ndarray], classes: np.ndarray, steps: int = 1_000, batch: int = 128, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights after ``steps`` of Adam on windows of texts held in memory."""
    net = started(_class_pairs(lines, classes), seed)
    return stepped(net, lines, classes, steps, batch, seed) if lines else net


def log10_probability(weights: Weights, lines: list[np.ndarray], most: int = 256) -> np.ndarray:
    """log10 P of each text of ids, its end included; ``most`` windows at a time."""
    inputs, targets, owner = windows(lines)
    score = np.zeros(len(lines))
    for at in range(0, len(owner), most):
        part = slice(at, at + most)
        want = np.maximum(targets[part], 0)
        each = class_log_probability(weights.net, weights.classes[inputs[part]], weights.classes[want]) / np.log(10)
        each = np.where(targets[part] >= 0, each + weights.shares[want], 0)
        score += np.bincount(owner[part], each.sum(axis=1), minlength=len(lines))
    return score


def _encoded(proto: bytes, words: list[bytes]) -> list[bytes]:
    """The packed subword ids of distinct words; the empty word is the end of a text.

    The library is loaded anew for each bucket: kept in a worker, it would take memory in all later stages.
    """
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    packed = []
    for at in range(0, len(words), WORDS_AT_ONCE):
        some = words[at : at + WORDS_AT_ONCE]
        found = library.encode(["▁" + w.decode(errors="replace") for w in some], num_threads=1)
        packed += [np.array(ids if w else [END], np.uint16).tobytes() for w, ids in zip(some, found)]
    return packed


def _planes(numbers: np.ndarray) -> bytes:
    """The first bytes of all numbers, then their second ones and so on: small numbers are packed better so."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _from_planes(rows: list[bytes], kind: type) -> list[np.ndarray]:
    width = np.dtype(kind).itemsize
    return [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(width, -1).T).view(kind).ravel() for x in rows]


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows in tables of at most ``most`` bytes of text, or of one longer text."""
    held: list[pa.RecordBatch] = []
    room = most
    for batch in batches:
        ends = np.append(0, np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False), dtype=np.int64))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(ends, ends[at] + room, "right")) - 1
            if upto == at and not held:
                upto += 1
            if upto > at:
                held.append(batch.slice(at, upto - at))
                room -= ends[upto] - ends[at]
            if upto < batch.num_rows or room <= 0:
                yield pa.Table.from_batches(held)
                held, room = [], most
            at = upto
    if held:
        yield pa.Table.from_batches(held)


def _numbered_words(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """How many words each text has, where these stand in the list of distinct words, and that list."""
    lists = [words_of(part.slice(at, SLICE)) for part in texts.chunks for at in range(0, len(part), SLICE)]
    size = np.concatenate([pc.list_value_length(x).to_numpy() for x in lists])
    found = pa.chunked_array([x.flatten() for x in lists]).dictionary_encode().combine_chunks()
    return size, found.indices.to_numpy(), found.dictionary.cast(pa.binary()).to_pylist()


def chunks_of(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of two kinds, all with their ``chunk``.

    Of each text: (id, trains, places), where its words and its end stand in the chunk's list of distinct words. Of each
    chunk and ``bucket``: (words, at, n), words of that list strung together with spaces, where they stand in it, and how
    often the chunk's training texts hold them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for number, table in enumerate(_cut(batches, CHUNK_BYTES)):
            ids, trains = table["id"].combine_chunks(), table["trains"].combine_chunks()
            size, place, words = _numbered_words(table["text"])
            del table
            places = pa.array([_planes(x) for x in np.split(place, np.cumsum(size)[:-1])], pa.binary())
            n = np.bincount(place[np.repeat(trains.to_numpy(zero_copy_only=False).astype(bool), size)], minlength=len(words))
            bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
            order = np.argsort(bucket, kind="stable").astype(np.int32)
            own, first = np.unique(bucket[order], return_index=True)
            parts = np.split(order, first[1:])
            for count, columns in (
                (len(ids), {"id": ids, "trains": trains, "places": places}),
                (
                    len(own),
                    {
                        "bucket": pa.array(own.astype(np.int32)),
                        "words": pa.array([b" ".join([words[i] for i in p]) for p in parts], pa.binary()),
                        "at": pa.array([_planes(p) for p in parts], pa.binary()),
                        "n": pa.array([_planes(n[p].astype(np.int64)) for p in parts], pa.binary()),
                    },
                ),
            ):
                columns["chunk"] = pa.array(np.full(count, part + number))
                kinds = {"chunk": pa.int64(), "id": ids.type, "trains": pa.bool_(), "places": pa.binary()}
                kinds |= {"bucket": pa.int32(), "words": pa.binary(), "at": pa.binary(), "n": pa.binary()}
                yield pa.record_batch([columns.get(c, pa.nulls(count, t)) for c, t in kinds.items()], names=list(kinds))

    kept = f"chunk long, id {dict(rows.dtypes)['id']}, trains boolean, places binary, bucket int, words binary, at binary, n binary"
    return rows.mapInArrow(cut, kept)


def counted_words(chunks: DataFrame, model: str) -> DataFrame:
    """(chunk, at, n, sizes, ids, total, kinds): words' numbers in the training texts of all chunks and their subword ids.

    ``total`` and ``kinds`` are a bucket's words in training texts, repeated and not, and stand in one of its rows.
    """

    proto = pieces_of(model).plain.serialized_model_proto()

    def count(table: pa.Table) -> pa.Table:
        lists = pc.split_pattern(table["words"].combine_chunks(), b" ")
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        found = lists.flatten().dictionary_encode()
        code, words = found.indices.to_numpy(), found.dictionary.to_pylist()
        # Whole numbers below 2 ** 53 are exact here.
        n = np.bincount(code, np.concatenate(_from_planes(table["n"].to_pylist(), np.int64)), len(words)).astype(np.int64)
        edges, ids = _packed(_encoded(proto, words))
        columns: dict[str, list[bytes]] = {"n": [], "sizes": [], "ids": []}
        for own in np.split(code, ends[:-1]):
            line, begins = _gathered(own, edges, ids)
            for name, x in (("n", n[own]), ("sizes", np.diff(begins).astype(np.int32)), ("ids", line)):
                columns[name].append(_planes(x))
        packed = {name: pa.array(x, pa.binary()) for name, x in columns.items()}
        once = {name: np.append(x, np.zeros(len(lists) - 1, np.int64)) for name, x in (("total", n.sum()), ("kinds", (n > 0).sum()))}
        return pa.table({"chunk": table["chunk"], "at": table["at"]} | packed | once)

    asked = chunks.filter("bucket is not null").select("chunk", "bucket", "words", "at", "n")
    return asked.groupBy("bucket").applyInArrow(count, "chunk long, at binary, n binary, sizes binary, ids binary, total long, kinds long")


def _packed(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's ids begin (and the last ends), and all ids."""
    edges = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows)) // 2, out=edges[1:])
    return edges, np.frombuffer(b"".join(rows), np.uint16)


def _gathered(rows: np.ndarray, edges: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the given rows strung together, and where each row's begin (and the last ends)."""
    size = np.diff(edges)[rows]
    begins = np.append(0, np.cumsum(size))
    place = np.arange(begins[-1]) + np.repeat(edges[rows] - begins[:-1], size)
    return ids[place], begins


def _lines_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16).astype(np.int32) for x in batch["ids"].to_pylist()]


def _summed(training: DataFrame, cells: int, add) -> np.ndarray:
    """A table of ``cells`` numbers that ``add(table, lines)`` counts in each task, summed over all tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                add(total, _lines_of(batch.slice(at, SLICE)))
        held = np.flatnonzero(total)
        for at in range(0, len(held), 1 << 18):
            part = held[at : at + (1 << 18)]
            yield pa.record_batch([pa.array(part), pa.array(total[part].astype(np.int64))], names=["cell", "n"])

    found = training.select("ids").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(cells, np.int64)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table


def windows_of_round(lines: list[np.ndarray], turn: int) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets that round ``turn`` goes through: all if they are few, else each window in one round of ``ROUNDS``."""
    few = sum(-(-len(x) // STRIDE) for x in lines) <= LEAST_STEPS * BATCH
    return windows(lines, slice(None) if few else slice(turn, None, ROUNDS))[:2]


def _averaged(training: DataFrame, net: dict[str, np.ndarray], classes: np.ndarray, turn: int) -> dict[str, np.ndarray]:
    """The weights after one round: each partition trains on its texts' windows of the round, then the weighted mean is taken."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lines, held, drawn, own = TaskContext.get().partitionId(), [], 0, 0, net

        def go_on() -> None:
            nonlocal lines, held, drawn, own
            inputs, targets = windows_of_round(lines, turn)
            batch = min(max(BATCH, len(inputs) // LEAST_STEPS), LARGEST_BATCH)
            steps = max(0 if drawn else LEAST_STEPS, -(-len(inputs) // batch))
            own = _stepped(own, inputs, targets, classes, steps, batch, (7, turn, part, drawn), turn / ROUNDS, (turn + 1) / ROUNDS)
            lines, held, drawn = [], 0, drawn + len(inputs)

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                more = _lines_of(batch.slice(at, SLICE))
                lines, held = lines + more, held + sum(map(len, more))
                if held >= HELD:
                    go_on()
        if lines:
            go_on()
        if drawn:
            flat = np.concatenate([w.ravel() for w in own.values()]).astype(np.float64) * drawn
            pieces = [x.tobytes() for x in np.array_split(flat, PIECES)]
            columns = [np.arange(PIECES), np.full(PIECES, part), np.full(PIECES, drawn), pa.array(pieces, pa.binary())]
            yield pa.record_batch([pa.array(c) for c in columns], names=["piece", "part", "drawn", "sums"])

    def mean(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.sum([np.frombuffer(x) for x in table["sums"].to_pylist()], axis=0) / table["drawn"].to_numpy().sum()
        return pa.table({"piece": table["piece"].slice(0, 1), "mean": pa.array([total.tobytes()], pa.binary())})

    each = training.select("ids").mapInArrow(train, "piece long, part long, drawn long, sums binary")
    found = dict(map(tuple, each.groupBy("piece").applyInArrow(mean, "piece long, mean binary").collect()))
    if not found:
        return net
    flat = np.concatenate([np.frombuffer(found[i]) for i in range(PIECES)]).astype(np.float32)
    edges = np.cumsum([w.size for w in net.values()])[:-1]
    return {n: x.reshape(w.shape) for (n, w), x in zip(net.items(), np.split(flat, edges))}


def fit(training: DataFrame, model: str) -> Weights:
    """Classes, shares and network from all training texts (ids)."""
    vocabulary = pieces_of(model).library.get_piece_size()
    def add_subwords(table: np.ndarray, lines: list[np.ndarray]) -> None:
        table += np.bincount(np.concatenate(lines), minlength=vocabulary).astype(np.int32)

    total = _summed(training, vocabulary, add_subwords)
    places = _places(total)
    neighbours = None
    if len(places.rest) > CLASSES - 1 - SINGLES:
        shape = (len(places.rest), 2 * CONTEXT)
        add = lambda table, lines: _add_neighbours(table.reshape(shape), lines, places)
        neighbours = _summed(training, shape[0] * shape[1], add).reshape(shape)
    classes = _class_table(places, neighbours)

    def add_pairs(table: np.ndarray, lines: list[np.ndarray]) -> None:
        table += _class_pairs(lines, classes).astype(np.int32)

    net = started(_summed(training, CLASSES * CLASSES, add_pairs))
    for turn in range(ROUNDS):
        net = _averaged(training, net, classes, turn)
    smooth = total + 1
    return Weights(classes, np.log10(smooth / np.bincount(classes, smooth, minlength=CLASSES)[classes]), net)


def scored(
    docs: DataFrame,
    trains: Column,
    model: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each row's (id, n_tokens, n_known, train_tokens, base_score, score).

    ``base_score`` is the add-one unigram score of the words; ``score`` is the model's. A null text counts as empty: its
    one token is the end. Null ids are kept. Without training texts all counts are 0. Repeated rows are scored, and
    counted, each. Other columns are not read; no rows give no rows.
    """
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(F.col(text_column)).alias("text"), trains.alias("trains"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // CHUNK_BYTES))
    with shuffle_files_removed(docs.sparkSession):
        return _scored(rows, buckets, model).withColumnRenamed("id", id_column)


def _scored(rows: DataFrame, buckets: int, model: str) -> DataFrame:
    if pieces_of(model).library.get_piece_size() > 1 << 16:
        raise ValueError("subword ids are kept in two bytes")
    chunks = stored(chunks_of(rows, buckets), "lm-chunks")
    words = stored(counted_words(chunks, model), "lm-words")
    total, kinds = words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "kinds"))).first()

    def encode(texts: pa.Table, table: pa.Table) -> pa.Table:
        at, n, sizes, ids = (
            np.concatenate(_from_planes(table[c].to_pylist(), kind))
            for c, kind in (("at", np.int32), ("n", np.int64), ("sizes", np.int32), ("ids", np.uint16))
        )
        edges = np.append(0, np.cumsum(sizes, dtype=np.int64))
        row_of = np.empty(len(at), np.int64)
        row_of[at] = np.arange(len(at))
        log = np.log10(n + 1) - np.log10(total + kinds + 1)
        found = []
        for begin in range(0, len(texts), SLICE):
            places = _from_planes(texts["places"].slice(begin, SLICE).to_pylist(), np.int32)
            size = np.array([len(x) for x in places])
            row, first = row_of[np.concatenate(places)], np.cumsum(size) - size
            line, starts = _gathered(row, edges, ids)
            packed = [x.tobytes() for x in np.split(line, starts[first[1:]])]
            n_known = np.add.reduceat((n[row] > 0).astype(np.int64), first)
            found.append((size, n_known, np.add.reduceat(log[row], first), np.array(packed, object)))
        n_tokens, n_known, base, packed = (pa.array(np.concatenate(c)) for c in zip(*found))
        columns = {"id": texts["id"], "trains": texts["trains"], "n_tokens": n_tokens, "n_known": n_known}
        columns |= {"train_tokens": pa.array(np.full(len(texts), total, np.int64)), "base_score": base, "ids": packed}
        return pa.table(columns)

    kept = f"id {dict(rows.dtypes)['id']}, %sn_tokens long, n_known long, train_tokens long, base_score double"
    encoded = (
        chunks.filter("bucket is null")
        .select("chunk", "id", "trains", "places")
        .groupBy("chunk")
        .cogroup(words.select("chunk", "at", "n", "sizes", "ids").groupBy("chunk"))
        .applyInArrow(encode, kept % "trains boolean, " + ", ids binary")
    )
    encoded = stored(encoded, "lm-ids")
    released(chunks, words)
    weights = fit(encoded.filter("trains"), model)
    names = ["id", "n_tokens", "n_known", "train_tokens", "base_score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [log10_probability(weights, _lines_of(batch.slice(at, SLICE))) for at in range(0, batch.num_rows, SLICE)]
            scores = pa.array(np.concatenate([np.zeros(0), *found]))
            yield pa.record_batch([*(batch[c] for c in names), scores], names=[*names, "score"])

    return encoded.select(*names, "ids").mapInArrow(score, kept % "" + ", score double")
