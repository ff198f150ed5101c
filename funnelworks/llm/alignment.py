"""Alignment of two tokenizers' tokens over the same bytes.

A text with a space in front is cut before every space or line feed that
follows a character other than white space, and before ASCII marks that
follow a letter (``Aligner`` looks whether that holds for its tokenizers).
Neither tokenizer has a token over such a cut and neither looks across it, so
a text's tokens, links and groups are those of its pieces one after the other,
and each Python worker works a distinct piece out once while it remembers it.

Groups of new pieces come by pointer jumping over all their tokens at once:
every token points to the farthest-right token that overlaps it, and pointers
are doubled until each shows its component's terminal token, which labels the
group.

Counting: the distinct id pairs of each document are added up over the
corpus, the highest count of each A id is found, and both go back to the
documents' pairs.  Pairs that make up at least one in ``HOT`` of all (document,
pair) rows, of which there can be no more than ``HOT``, are sent to the tasks;
the others are joined by an exchange, which thus has no hot key.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelworks.llm.storage import stored
from funnelworks.llm.words import slices, white_space

#: Bound on pairs sent to the tasks.
HOT = 1 << 20
#: Pieces that a worker remembers, and their bytes at most; longer ones are worked out each time.
MEMO_PIECES, MEMO_BYTES = 400_000, 64
#: New pieces that are given to the tokenizers in one text.
JOINED = 500
_CONTROL = "\n"
#: Distinct pairs of a task that are gathered before they are passed on.
GATHER = 1 << 20
#: A pair of ids as one number.
PAIR = 1 << 32
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: ASCII marks but for ' (of contractions).
_MARK[[*range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_workers: dict[tuple[str, str], Aligner] = {}


def byte_letters() -> dict[str, int]:
    """Byte of each letter that a byte-level tokenizer writes for it: printable
    Latin-1 stands for itself, the others for letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """Terminal token of every token's component, A's tokens before B's, for
    two cuttings of the same bytes given by their tokens' ends."""
    n = len(end_a)
    # the last token of the other side that begins before this one's end
    to_b = np.searchsorted(end_b, end_a, "left") + n
    to_a = np.searchsorted(end_a, end_b, "left")
    both = end_a[to_a] == end_b
    to_a[both] = np.flatnonzero(both) + n  # both end here: B's token ends the component
    jump = np.concatenate((to_b, to_a))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump
        jump = further


def overlaps(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of all pairs whose byte ranges overlap."""
    start_a = np.concatenate(([0], end_a[:-1]))
    first = np.searchsorted(end_b, start_a, "right")
    count = np.searchsorted(end_b, end_a, "left") - first + 1
    a = np.repeat(np.arange(len(end_a)), count)
    within = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    return a, first[a] + within


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places starts[i] .. starts[i] + counts[i] - 1, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def decimals(values: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Values (below 10^9) in decimal with a mark behind each, and their ends."""
    width = np.ones(len(values), np.int64)
    for k in range(1, 9):
        width += values >= 10**k
    ends = np.cumsum(width + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = marks
    for k in range(int(width.max(initial=0))):
        long = width > k
        out[ends[long] - 2 - k] = 48 + values[long] // 10**k % 10
    return out.tobytes(), ends


class Pieces:
    """Facts of pieces by number: tokens, groups, text of groups (with ; behind
    each), links (flat), and how often they were met."""

    def __init__(self):
        self.n = 0
        self.facts = np.zeros((1024, 3), np.int64)  # a, b, groups; a < 0: bytes differ
        self.text: list[bytes] = []
        self.first = np.zeros(1025, np.int64)
        self.links = np.zeros(4096, np.int64)
        self.met = np.zeros(1024, np.int64)

    def add(self, facts: np.ndarray, text: list[bytes], counts: np.ndarray, links: np.ndarray) -> None:
        n, m = self.n + len(facts), int(self.first[self.n]) + len(links)
        if n + 1 > len(self.first):
            self.facts = np.concatenate((self.facts, np.zeros((n, 3), np.int64)))
            self.first = np.concatenate((self.first, np.zeros(n, np.int64)))
            self.met = np.concatenate((self.met, np.zeros(n, np.int64)))
        if m > len(self.links):
            self.links = np.concatenate((self.links, np.zeros(m, np.int64)))
        self.facts[self.n : n] = facts
        self.links[m - len(links) : m] = links
        self.first[self.n + 1 : n + 1] = self.first[self.n] + np.cumsum(counts)
        self.text += text
        self.n = n

    def only(self, keep: np.ndarray) -> Pieces:
        out = Pieces()
        counts = self.first[keep + 1] - self.first[keep]
        out.add(self.facts[keep], [self.text[i] for i in keep.tolist()], counts, self.links[_ragged(self.first[keep], counts)])
        return out


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings are plain text
        splits = str(self.a.pre_tokenizer)
        if self.a.normalizer is not None or not splits.startswith("ByteLevel(add_prefix_space=False") or "use_regex=True" not in splits:
            raise ValueError(f"{path_a}: not a plain byte-level tokenizer")
        letters = byte_letters()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            plain = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if plain else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(t[3:5], 16)]) if self.b.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)
        ]
        whole = [t for i, t in enumerate(names) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        if any("▁" in t.lstrip("▁") for t in whole):
            raise ValueError(f"{path_b}: pieces with a space inside can't be cut at spaces")
        # a control character has no piece, so that nothing joins it: it may stand where the library puts its space
        self.space = self.b.piece_to_id("▁")
        front = self.b.encode(_CONTROL)
        if front[0] != self.space or len(front) != 2 or any(_CONTROL in t for t in whole):
            raise ValueError(f"{path_b}: line feeds aren't apart from other text")
        self.marks = not any(x.isalpha() and not y.isalnum() for t in whole for x, y in zip(t, t[1:], strict=False))
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.pieces, self.memo = Pieces(), {}

    def _forget(self) -> None:
        """Keep half as many pieces as are remembered, those met most often."""
        numbers = np.fromiter(self.memo.values(), np.int64, len(self.memo))
        order = np.argsort(-self.pieces.met[numbers], kind="stable")[: MEMO_PIECES // 2]
        names = list(self.memo)
        self.memo = {names[i]: k for k, i in enumerate(order.tolist())}
        self.pieces = self.pieces.only(numbers[order])

    def _tokens(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text, a piece or several, as if it stood inside another."""
        a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # the library puts a space in front of all but the empty text
        spaced = [t[0] == " " for t in texts]
        b = self.b.encode([t[1:] if own else _CONTROL + t for t, own in zip(texts, spaced, strict=True)], num_threads=1)
        b = [[self.space] if t == " " else x if own else x[2:] for t, own, x in zip(texts, spaced, b, strict=True)]
        return a, b

    def _encode(self, new: list[bytes]) -> tuple[np.ndarray, ...]:
        """For pieces: ids of A, their number by piece, the same of B, and
        whether both give the piece's bytes.  Pieces of a space and what ends
        in a letter or mark keep their tokens when they follow each other, so
        many go as one text; if its bytes differ, and all others, alone."""
        ids = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        counts = [np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)]
        same = np.zeros(len(new), bool)
        placed: list[list[tuple[int, np.ndarray]]] = [[], []]  # by side: first piece, ids
        alone, joined = [], []
        for i, p in enumerate(new):
            last = p[-1]
            ends = last > 32 and (last < 127 or p[-2:-1] == b"\xc3") and p[0] == 32
            (joined if ends else alone).append(i)
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        order: list[int] = []
        if groups:
            texts = [b"".join([new[i] for i in g]) for g in groups]
            for g, text, *both in zip(groups, texts, *self._tokens([t.decode() for t in texts]), strict=True):
                if any(b"".join([table[i] for i in x]) != text for table, x in zip((self.a_bytes, self.b_bytes), both, strict=True)):
                    alone += g
                    continue
                ends = np.cumsum([len(new[i]) for i in g])
                for side, (x, length) in enumerate(zip(both, (self.length_a, self.length_b), strict=True)):
                    x = np.array(x, np.int64)
                    cuts = np.searchsorted(np.cumsum(length[x]), ends, "right")
                    counts[side][g] = np.diff(cuts, prepend=0)
                    placed[side].append((len(order), x))
                same[g] = True
                order += g
        if alone:
            for i, *both in zip(alone, *self._tokens([new[i].decode() for i in alone]), strict=True):
                ok = all(b"".join([table[j] for j in x]) == new[i] for table, x in zip((self.a_bytes, self.b_bytes), both, strict=True))
                for side, x in enumerate(both):
                    x = np.array(x if ok else [], np.int64)
                    counts[side][i] = len(x)
                    placed[side].append((len(order), x))
                same[i] = ok
                order.append(i)
        # back from the order of work to that of the pieces
        at = np.array(order, np.int64)
        for side in range(2):
            flat = np.concatenate([x for _, x in placed[side]]) if placed[side] else ids[side]
            starts = np.zeros(len(new), np.int64)
            starts[at] = np.cumsum(counts[side][at]) - counts[side][at]
            ids[side] = flat[_ragged(starts, counts[side])]
        return ids[0], counts[0], ids[1], counts[1], same

    def _work_out(self, new: list[bytes]) -> None:
        """Add pieces."""
        id_a, n_a, id_b, n_b, same = self._encode(new)
        n = len(new)
        end_a, end_b = np.cumsum(self.length_a[id_a]), np.cumsum(self.length_b[id_b])
        piece_a, piece_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        left, right = overlaps(end_a, end_b)
        links = id_a[left] * PAIR + id_b[right]
        # groups are labelled by their terminals, tokens of B, in order of place
        marks, number = np.unique(terminals(end_a, end_b), return_inverse=True)
        n_groups = np.bincount(piece_b[marks - len(end_a)], minlength=n)
        # A's ids of a group, then B's; a comma, or what ends the side
        side = 2 * number + (np.arange(len(number)) >= len(end_a))
        order = np.argsort(side, kind="stable")
        ends = np.append(side[order][1:] != side[order][:-1], len(side) > 0)[: len(side)]
        mark = np.where(ends, np.where(side[order] % 2, ord(";"), ord("|")), ord(",")).astype(np.uint8)
        said, bounds = decimals(np.concatenate((id_a, id_b))[order], mark)
        stops = np.concatenate(([0], bounds))[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        text = [said[i:j] for i, j in zip(stops[:-1], stops[1:], strict=True)]
        facts = np.column_stack((np.where(same, n_a, -1), n_b, n_groups))
        self.pieces.add(facts, text, np.bincount(piece_a[left], minlength=n), links)

    def _starts(self, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
        space = white_space(data)
        cut = (data == 32) | (data == 10)
        cut[1:] &= ~space[:-1]
        if self.marks:
            letter = _LETTER[data]
            pair = np.flatnonzero(data[:-1] == 0xC3)
            letter[pair + 1] = (data[pair + 1] != 0x97) & (data[pair + 1] != 0xB7)  # but for two signs
            cut[1:] |= letter[:-1] & _MARK[data[1:]]
        cut[borders[:-1]] = True
        return np.flatnonzero(cut)

    def documents(self, data: np.ndarray, borders: np.ndarray):
        """For texts with a space in front: facts (rows of a, b, groups, all 0
        where bytes differ), texts of the groups, links' documents and links."""
        n = len(borders) - 1
        starts = self._starts(data, borders)
        whole, bounds = data.tobytes(), np.append(starts, len(data)).tolist()
        pieces = [whole[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
        if len(self.memo) > MEMO_PIECES or self.pieces.n > 2 * MEMO_PIECES:
            self._forget()
        new = list(set(pieces).difference(self.memo))
        if new:
            self.memo.update(zip(new, range(self.pieces.n, self.pieces.n + len(new)), strict=True))
            self._work_out(new)
        number = np.fromiter(map(self.memo.__getitem__, pieces), np.int64, len(pieces))
        table = self.pieces
        np.add.at(table.met, number, 1)
        first = np.searchsorted(starts, borders)
        row = np.repeat(np.arange(n), np.diff(first))
        own = table.facts[number]
        good = np.bincount(row[own[:, 0] < 0], minlength=n) == 0
        facts = np.column_stack([np.bincount(row, own[:, i], n).astype(np.int64) for i in range(3)]) * good[:, None]
        said = list(map(table.text.__getitem__, number.tolist()))
        ends = first.tolist()
        texts = [b"".join(said[i:j])[:-1] if ok else b"" for i, j, ok in zip(ends[:-1], ends[1:], good.tolist(), strict=True)]
        use = good[row]
        number, row = number[use], row[use]
        count = table.first[number + 1] - table.first[number]
        links = table.links[_ragged(table.first[number], count)]
        for p in new:
            if len(p) > MEMO_BYTES:
                del self.memo[p]
        return facts, texts, np.repeat(row, count), links


def aligner(path_a: str, path_b: str) -> Aligner:
    key = (path_a, path_b)
    if key not in _workers:
        _workers[key] = Aligner(*key)
    return _workers[key]


def _spaced(data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that aren't empty with a space in front of each."""
    return np.insert(data, borders[:-1], 32), borders + np.arange(len(borders))


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary, pairs array<long>, times array<int>"


def _align(path_a: str, path_b: str, digest: bool):
    def run(batches):
        worker = aligner(path_a, path_b)
        for batch in batches:
            for lo, hi, data, borders in slices(batch.column(1)):
                n = hi - lo
                full = np.flatnonzero(np.diff(borders))
                facts, texts = np.zeros((n, 3), np.int64), [b""] * n
                doc, links = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if len(full):
                    own, said, doc, links = worker.documents(*_spaced(data, np.append(borders[full], borders[-1])))
                    facts[full] = own
                    for i, t in zip(full.tolist(), said, strict=True):
                        texts[i] = t
                    doc = full[doc]
                order = np.lexsort((links, doc))
                doc, links = doc[order], links[order]
                new = np.ones(len(links), bool)
                new[1:] = (links[1:] != links[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                ends = pa.array(np.searchsorted(doc[at], np.arange(n + 1)).astype(np.int32))
                said = [hashlib.sha256(t).hexdigest().encode() if t else b"" for t in texts] if digest else texts
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, n),
                        *(pa.array(facts[:, i]) for i in range(3)),
                        pa.array(np.bincount(doc, minlength=n)),
                        pa.array(said, pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(links[at])),
                        pa.ListArray.from_arrays(ends, pa.array(np.diff(np.append(at, len(links))).astype(np.int32))),
                    ],
                    [f.split()[0] for f in _ALIGNED.split(", ")],
                )

    return run


def _pair_counts(batches):
    """(pair, n) of a task's documents, summed over up to GATHER entries."""
    have: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def merged():
        pairs, place = np.unique(np.concatenate([h[0] for h in have]), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate([h[1] for h in have])).astype(np.int64)

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in have[0]], ["pair", "n"])

    for batch in batches:
        have.append(np.unique(batch.column(0).flatten().to_numpy(), return_counts=True))
        size += len(have[-1][0])
        if size > GATHER:
            have = [merged()]
            size = len(have[0][0])
            if size > GATHER // 2:
                yield rows()
                have, size = [], 0
    if have:
        have = [merged()]
        yield rows()


def _meet(hot):
    """Per row: sums over its hot pairs, and its other pairs."""

    def run(batches):
        pairs, counts, best = hot.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = len(batch)
            own, times = batch.column("pairs"), batch.column("times")
            holder = np.repeat(np.arange(n), own.value_lengths().to_numpy(zero_copy_only=False))
            p, t = own.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(pairs, p), max(len(pairs) - 1, 0))
            is_hot = pairs[at] == p if len(pairs) else np.zeros(len(p), bool)
            place, t_hot, hit = holder[is_hot], t[is_hot], at[is_hot]
            n_best = np.bincount(place, t_hot * best[hit], n).astype(np.int64)
            total = np.zeros(n, np.int64)
            np.add.at(total, place, t_hot * counts[hit])
            cold = ~is_hot
            others = pa.StructArray.from_arrays([pa.array(p[cold]), pa.array(t[cold])], ["pair", "times"])
            ends = np.searchsorted(holder[cold], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)),
                    *(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")),
                    pa.array(n_best),
                    pa.array(total),
                    pa.ListArray.from_arrays(pa.array(ends), others),
                ],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "hot_best", "hot_sum", "others"],
            )
            row += n

    return run


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The tokens of each row of ``docs`` (needs doc_id, text): doc_id, n_a,
    n_b, n_groups, n_links, groups (binary text `a1,a2|b1;a3|b2`), pairs (the
    distinct A id * 2^32 + B id of overlapping tokens), times (links of each).

    A: a byte-level .json tokenizer, over a space and the text.  B: a
    sentencepiece .model that puts the space there itself.  No special
    tokens; their strings are plain text.  Groups end where tokens of both
    end.  Null and empty texts, and those whose joined A or B bytes aren't the
    space and the text, have no tokens: zeros, '' and empty arrays.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_align(path_a, path_b, False), _ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many rows hold the pair, and whether no other pair
    of its A id has more."""
    found = aligned.select("pairs").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = stored(found, "pair-counts")
    of_a = F.shiftright("pair", 32)
    highest = found.groupBy(of_a.alias("a")).agg(F.max("n").alias("highest"))
    # a row an A id: at most the vocabulary
    return found.join(F.broadcast(highest), of_a == F.col("a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def alignment_scores(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links,
    n_best (links whose id pair is in as many rows as any pair of its A id),
    count_sum (over links, rows that hold the pair), groups_sha256 (of
    ``align``'s groups; '' without tokens).

    Each row is a document: repeated rows count each, null doc_ids are
    carried.  Rows without tokens: zeros.  Empty table: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    aligned = stored(rows.mapInArrow(_align(path_a, path_b, True), _ALIGNED), "aligned")
    known = stored(pair_counts(aligned), "pairs")
    total = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") * HOT >= total
    table = known.where(is_hot).toArrow()  # HOT rows at most
    pairs, counts, best = (table.column(i).to_numpy() for i in range(3))
    order = np.argsort(pairs)
    hot = docs.sparkSession.sparkContext.broadcast((pairs[order], counts[order], best[order]))
    keep = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]
    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups binary, hot_best long, hot_sum long"
    met = aligned.mapInArrow(_meet(hot), schema + ", others array<struct<pair:long,times:int>>")
    met = met.select(*keep, "hot_best", "hot_sum", F.inline_outer("others"))
    # a row without other pairs joins nothing, under a number of its own: no common null key
    met = met.withColumn("pair", F.coalesce("pair", -1 - F.col("row")))
    joined = met.join(known.where(~is_hot), "pair", "left")
    times = F.col("times").cast("long")
    scored = joined.groupBy("row").agg(
        *[F.first(c).alias(c) for c in keep[1:]],
        (F.max("hot_best") + F.sum(F.when(F.col("best"), times).otherwise(0))).alias("n_best"),
        (F.max("hot_sum") + F.sum(F.coalesce(times * F.col("n"), F.lit(0)))).alias("count_sum"),
    )
    return scored.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").cast("string").alias("groups_sha256")
    )
