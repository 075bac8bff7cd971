"""Byte pair encoding and decoding with an index of pair occurrences.

The words that a slice of a partition brings and that are not known yet are laid out in one
sequence of symbols. An index maps every mergeable pair to all its positions there. The
active rank that is lowest is applied at all its positions at once; each merge touches only
the lists of the pairs beside it.
"""

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceline.llm.batches import slices, small_batches, with_columns, without
from paceline.llm.words import TextIds

#: Positions from which on a list is worked on as a whole, and how many shorter lists in a row end that.
LONG, SHORT_IN_A_ROW = 24, 12
#: Bytes of text whose new words are merged together.
SLICE = 2_000_000


def taking_turns(firsts, seconds):
    """Of overlapping pairs the first one, the third one and so on."""
    kept, taken = [], -1
    for first, second in zip(firsts.tolist(), seconds.tolist()):
        if first != taken:
            kept.append(first)
            taken = second
    return np.array(kept, dtype=np.int64)


class PairIndex:
    """Merges for a list of words at once."""

    def __init__(self, model):
        self.ids = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self.merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        self.width = max(self.ids.values()) + 2
        self.ranks = {a * self.width + b: rank for rank, (a, b, _) in enumerate(self.merges)}
        self.codes = np.array(sorted(self.ranks), dtype=np.int64)
        self.code_ranks = np.array([self.ranks[c] for c in self.codes.tolist()], dtype=np.int64)
        made = {}
        for rank, (_, _, whole) in enumerate(self.merges):
            made[whole] = rank
        # then no merge makes a pair of a lower rank, and a rank can be applied everywhere before the next one
        self.in_order = all(made.get(a, -1) < rank and made.get(b, -1) < rank for rank, (a, b, _) in enumerate(self.merges))
        self.last = {c: self.ids[c + self.suffix] for c in self.ids if c + self.suffix in self.ids}

    def occurrences(self, symbols):
        """rank -> ascending positions of its pair, for every mergeable pair of neighbours."""
        numbers = np.array(symbols, dtype=np.int64)
        codes = numbers[:-1] * self.width + numbers[1:]
        codes[(numbers[:-1] < 0) | (numbers[1:] < 0)] = -1
        found = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        positions = np.flatnonzero(self.codes[found] == codes)
        ranks = self.code_ranks[found[positions]]
        order = np.argsort(ranks, kind="stable")
        listed, first = np.unique(ranks[order], return_index=True)
        return {r: p.tolist() for r, p in zip(listed.tolist(), np.split(positions[order], first[1:]))}

    def _found(self, codes):
        """The rank of each pair, -1 if it has none."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.code_ranks[at], -1)

    def _merge_long_lists(self, symbols, places):
        """Apply ranks from the lowest on, each at all its positions at once, as long as lists are long.

        Changes ``places`` to the lists that are left; returns symbols and links as lists.
        """
        after = np.arange(1, len(symbols) + 1)
        before = np.arange(-1, len(symbols) - 1)
        active, short = sorted(places), 0
        while active and short < SHORT_IN_A_ROW:
            rank = heappop(active)
            left, right, merged = self.merges[rank]
            short = short + 1 if len(places[rank]) < LONG else 0
            todo = np.unique(np.array(places.pop(rank)))
            todo = todo[(symbols[todo] == left) & (symbols[after[todo]] == right)]
            if left == right:
                todo = taking_turns(todo, after[todo])
            second = after[todo]
            third = after[second]
            symbols[todo], symbols[second] = merged, -2
            after[todo] = third
            before[third] = todo
            first = before[todo]
            near = np.concatenate([first, todo])
            codes = np.concatenate([symbols[first] * self.width + merged, merged * self.width + symbols[third]])
            codes[np.concatenate([(first < 0) | (symbols[first] < 0), symbols[third] < 0])] = -1
            ranks = self._found(codes)
            known = np.flatnonzero(ranks >= 0)
            for found, place in zip(ranks[known].tolist(), near[known].tolist()):
                if found in places:
                    places[found].append(place)
                else:
                    places[found] = [place]
                    heappush(active, found)
        return symbols.tolist(), before.tolist(), after.tolist()

    def _merge_short_lists(self, symbols, before, after, places):
        """Apply the ranks that are left, position by position."""
        width, ranks = self.width, self.ranks
        active = sorted(places)
        while active:
            rank = heappop(active)
            left, right, merged = self.merges[rank]
            todo = places.pop(rank)
            if left == right:
                todo.sort()  # of overlapping pairs the first one wins
            for at, k in enumerate(todo):
                if active and active[0] < rank:  # a merge made a pair of a lower rank: that one comes first
                    places.setdefault(rank, []).extend(todo[at:])
                    heappush(active, rank)
                    break
                second = after[k]
                if symbols[k] != left or symbols[second] != right:
                    continue  # a merge beside it took one of the two
                symbols[k], symbols[second] = merged, -2
                third = after[k] = after[second]
                before[third] = k
                first = before[k]
                for place, code in ((first, symbols[first] * width + merged), (k, merged * width + symbols[third])):
                    found = ranks.get(code)
                    if found is None or place < 0:
                        continue
                    if found in places:
                        places[found].append(place)
                    else:
                        places[found] = [place]
                        heappush(active, found)

    def encode(self, words):
        """The ids of every word, as bytes of 32-bit integers; a word is a string of the vocabulary's base characters."""
        symbols, ends = [], []
        ids, last = self.ids, self.last
        for word in words:
            symbols += [ids[c] for c in word[:-1]]
            symbols.append(last[word[-1]])
            ends.append(len(symbols))
            symbols.append(-1)  # no pair crosses the end of a word
        if not words:
            return []
        places = self.occurrences(symbols)
        symbols, before, after = self._merge_long_lists(np.array(symbols, dtype=np.int64), places if self.in_order else {})
        self._merge_short_lists(symbols, before, after, places)
        left = np.array(symbols)
        upto = 4 * np.cumsum(left >= 0)[ends]
        data = left[left >= 0].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *upto.tolist()], upto.tolist())]


class Codec(TextIds):
    """Encodes texts with the pair index, as the tokenizer file says."""

    def __init__(self, path):
        super().__init__(path)
        self.index = PairIndex(self.content(path)["model"])

    def word_ids(self, words):
        return self.index.encode(words)


class Names:
    """The tokens of ids, special ones included. The tokenizer has no decoder, so tokens are joined by a space."""

    def __init__(self, path):
        content = TextIds.content(path)
        numbers = {**content["model"]["vocab"], **{t["content"]: t["id"] for t in content["added_tokens"]}}
        self.names = [""] * (max(numbers.values()) + 1)
        for name, number in numbers.items():
            self.names[number] = name

    def decode(self, ids):
        return " ".join(map(self.names.__getitem__, ids))


def encode(docs: DataFrame, tokenizer: str, text="text", column="ids", decoded=None) -> DataFrame:
    """Add the ids of each whole text as an array of ints; null and empty texts have none.

    ``decoded`` names a column for what the ids decode to, worked out in the same pass, which
    spares sending the ids to Python again. Columns of these names are replaced; rows stay
    where they are.
    """

    def work(batches):
        codec, names = Codec(tokenizer), Names(tokenizer) if decoded else None
        for batch in batches:
            for first, texts in slices(batch, text, SLICE):
                ids = codec.encode([t.decode() for t in texts])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                arrays = pa.ListArray.from_arrays(pa.array(offsets), values)
                added = {column: arrays}
                if decoded:
                    added[decoded] = pa.array([names.decode(np.frombuffer(x, dtype="<i4").tolist()) for x in ids], pa.string())
                yield with_columns(batch.slice(first, len(texts)), added)

    small_batches(docs.sparkSession)
    docs = without(docs, [column, decoded or column])
    added = [F.array().cast("array<int>").alias(column), *([F.lit(None).cast("string").alias(decoded)] if decoded else [])]
    schema = docs.select("*", *added).schema
    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, tokenizer: str, ids="ids", column="decoded") -> DataFrame:
    """Add the text of an array of ids; no ids give an empty text, and null gives null.

    A column of that name is replaced; rows stay where they are.
    """

    def work(batches):
        names = Names(tokenizer)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lists = part.column(ids)
                texts = [None if not x.is_valid else names.decode(x.values.to_pylist()) for x in lists]
                yield with_columns(part, {column: pa.array(texts, pa.string())})

    small_batches(encoded.sparkSession)
    encoded = without(encoded, [column])
    schema = encoded.select("*", F.lit(None).cast("string").alias(column)).schema
    return encoded.mapInArrow(work, schema)
