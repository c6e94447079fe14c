"""In how many texts each of very many phrases stands, by the texts' distinct words.

A phrase without a blank stands inside one word.  Of any other the first part ends a word,
the last part begins one, and the parts between are whole words.  So a few thousand texts
at a time give their distinct words, and each of these is looked up once: the phrases
inside it, the first parts that it ends with, the last parts that it begins with.  Distinct
pairs of neighbouring words then give the phrases of two parts, and longer ones go on from
there, word by word.  What a text holds is the union over its words and pairs.  The work is
that of the words and of what is found; how many phrases there are hardly matters.

Phrases are kept in tries and tables of numbers, some 10 bytes for a character that no
other phrase shares and 30 for each phrase of several parts.  Everything is compared
exactly; blanks may stand anywhere, in phrases and in texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Nodes of a trie, the first by depth, whose next nodes are listed for each byte.
DENSE = 4096
#: Bytes of texts that are worked on at once, and entries of a list that is laid out for them.
TEXT_BYTES, ENTRIES = 2 << 20, 1 << 18

Lists = tuple[np.ndarray, np.ndarray, np.ndarray]


def _bytes(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings one after the other, and where each begins and the last ends."""
    strings = pa.concat_arrays([strings.cast(pa.large_binary())])
    _, places, data = strings.buffers()
    places = np.frombuffer(places, np.int64)[strings.offset : strings.offset + len(strings) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), places


def _laid_out(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range, one range after the other."""
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(int(count.sum()))


def _lots(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbours whose sizes come to about ``most`` or that are alone."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        last = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield slice(at, last)
        at = last


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """The distinct numbers, in order."""
    numbers = np.sort(numbers)
    return numbers[np.flatnonzero(np.diff(numbers, prepend=-1))]


def _lists(owner: np.ndarray, value: np.ndarray, owners: int) -> Lists:
    """For each owner its values: where they begin, how many they are, and all values.  The owners come in order."""
    count = np.bincount(owner, minlength=owners)
    return np.cumsum(count) - count, count, value


class Trie:
    """Distinct strings by their bytes; a node's children follow each other, in the order of their bytes."""

    def __init__(self, strings: pa.Array):
        """The place of a string in ``strings`` is its number."""
        order = pc.sort_indices(strings.cast(pa.large_binary())).to_numpy()
        data, places = _bytes(strings)
        start, length = places[:-1][order], np.diff(places)[order]
        node, active = np.zeros(len(order), np.int32), np.flatnonzero(length > 0)
        parents, labels, nodes = [], [], 1
        ended = [(node[length == 0], order[length == 0])]
        depth = 0
        while len(active):
            byte, parent = data[start[active] + depth], node[active]
            new = np.ones(len(active), bool)
            new[1:] = (byte[1:] != byte[:-1]) | (parent[1:] != parent[:-1])
            node[active] = nodes - 1 + np.cumsum(new)
            nodes += int(new.sum())
            parents.append(parent[new])
            labels.append(byte[new])
            depth += 1
            whole = length[active] == depth
            ended.append((node[active[whole]], order[active[whole]]))
            active = active[~whole]
        parent = np.concatenate([*parents, np.zeros(0, np.int32)])
        self.label = np.concatenate([*labels, np.zeros(1, np.uint8)])
        self.first = np.concatenate([[1], 1 + np.cumsum(np.bincount(parent, minlength=nodes))]).astype(np.int32)
        self.ends = np.full(nodes, -1, np.int32)
        for at, number in ended:
            self.ends[at] = number
        self.dense = np.zeros((min(nodes, DENSE), 256), np.int32)
        child = np.arange(1, nodes, dtype=np.int32)
        near = parent < len(self.dense)
        self.dense[parent[near], self.label[:-1][near]] = child[near]

    def _child(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The next nodes, 0 where there is none."""
        if len(self.dense) == len(self.ends):
            return self.dense[node, byte]
        found = np.zeros(len(node), np.int32)
        near = node < len(self.dense)
        found[near] = self.dense[node[near], byte[near]]
        far = np.flatnonzero(~near)
        node, byte = node[far], byte[far]
        low, high = self.first[node], self.first[node + 1]
        end = high
        while (wide := low < high).any():
            middle = (low + high) >> 1
            less = wide & (self.label[middle - 1] < byte)  # label k - 1 is that of node k
            low, high = np.where(less, middle + 1, low), np.where(less, high, middle)
        there = (low < end) & (self.label[np.minimum(low, len(self.label) - 1) - 1] == byte)
        found[far] = np.where(there, low, 0)
        return found

    def found(self, data: np.ndarray, at: np.ndarray, owner: np.ndarray, owners: int, step: int = 1) -> Lists:
        """For each owner the numbers of all strings that are read from its places; a byte of no string stands at either end."""
        node, size = np.zeros(len(at), np.int32), len(self.ends)
        found = [np.zeros(0, np.int64)]
        while len(at):
            whole = self.ends[node] >= 0
            found.append(_distinct(owner[whole] * size + self.ends[node[whole]]))  # a string has one length
            node = self._child(node, data[at])
            on = np.flatnonzero(node)
            node, at, owner = node[on], at[on] + step, owner[on]
        pairs = np.sort(np.concatenate(found))
        return _lists(pairs // size, pairs % size, owners)


class Numbers:
    """Distinct numbers, not negative, with a value each, in an open table behind a filter."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(1.5 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.filter = np.zeros(4 << self.bits, bool)
        mixed = self._mixed(keys)
        self.filter[mixed >> np.uint64(62 - self.bits)] = True
        slot = self._slot(mixed)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]
            there = self.keys[slot] == keys
            self.values[slot[there]] = values[there]
            keys, values, slot = keys[~there], values[~there], (slot[~there] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _mixed(keys: np.ndarray) -> np.ndarray:
        return keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def _slot(self, mixed: np.ndarray) -> np.ndarray:
        return (mixed >> np.uint64(64 - self.bits)).view(np.int64)

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``keys``, in order, of numbers that are there, and their values."""
        mixed = self._mixed(keys)
        place = np.flatnonzero(self.filter[(mixed >> np.uint64(62 - self.bits)).view(np.int64)])
        found = np.full(len(place), -1, np.int64)
        on, keys, slot = np.arange(len(place)), keys[place], self._slot(mixed[place])
        while len(on):
            held = self.keys[slot]
            there = held == keys
            found[on[there]] = self.values[slot[there]]
            more = ~there & (held >= 0)
            on, keys, slot = on[more], keys[more], (slot[more] + 1) & (len(self.keys) - 1)
        there = found >= 0
        return place[there], found[there]


def _reversed(strings: pa.Array) -> pa.Array:
    return pc.binary_reverse(strings.cast(pa.large_binary()))


class Phrases:
    """Distinct phrases, none empty, made ready for the search."""

    def __init__(self, phrases: pa.Array):
        self.phrases = phrases.cast(pa.binary())
        parts = pc.split_pattern(phrases.cast(pa.large_binary()), b" ")
        words, places = parts.flatten(), parts.offsets.to_numpy()
        count = np.diff(places)
        self.alone = np.flatnonzero(count == 1)
        self.inside = Trie(self.phrases.take(pa.array(self.alone)))
        several = np.flatnonzero(count > 1)

        def numbered(at: np.ndarray) -> tuple[np.ndarray, pa.Array]:
            coded = words.take(pa.array(at)).dictionary_encode()
            return coded.indices.to_numpy().astype(np.int64), coded.dictionary

        head, firsts = numbered(places[several])
        last, lasts = numbered(places[several + 1] - 1)
        self.ending, self.beginning = Trie(_reversed(firsts)), Trie(lasts)
        self.lasts = len(lasts)
        between = count[several] - 2
        middle, self.middles = numbered(_laid_out(places[several] + 1, between))
        begin, self.heads = np.cumsum(between) - between, len(firsts)
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in range(int(between.max(initial=0))):  # the first k parts and the next one are a head of their own
            longer = np.flatnonzero(between > k)
            key, new = np.unique(head[longer] * len(self.middles) + middle[begin[longer] + k], return_inverse=True)
            head[longer] = self.heads + new
            keys.append(key)
            values.append(self.heads + np.arange(len(key)))
            self.heads += len(key)
        self.onward = Numbers(np.concatenate(keys), np.concatenate(values))
        self.whole = Numbers(head * self.lasts + last, several)


class Search:
    """The texts that hold each phrase, counted."""

    def __init__(self, phrases: Phrases):
        self.all = phrases
        self.counts = np.zeros(len(phrases.phrases), np.int64)
        self.seen = np.zeros(len(phrases.phrases), np.int32)

    def _count(self, texts: int, text: np.ndarray, owner: np.ndarray, lists: Lists) -> None:
        """Count for each text the distinct values of its owners; the texts come in order."""
        start, count, values = lists
        held = count[owner] > 0
        text, owner = text[held], owner[held]
        size = count[owner]
        ends = np.searchsorted(text, np.arange(texts + 1))
        per_text = np.diff(np.concatenate([[0], np.cumsum(size)])[ends])
        for lot in _lots(per_text, ENTRIES):
            rows = slice(ends[lot.start], ends[lot.stop])
            found = values[_laid_out(start[owner[rows]], size[rows])]
            at = 0
            for n in per_text[lot].tolist():
                if n:
                    here = found[at : at + n]
                    order = np.arange(n, dtype=np.int32)
                    self.seen[here] = order  # of equal ones a single one finds itself again
                    self.counts[here[self.seen[here] == order]] += 1
                    at += n

    def _onward(self, owner: np.ndarray, head: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
        """From heads and the words behind them to (owner, phrase) and (owner, longer head), in the order of the rows."""
        start, count, values = self.last
        several = count[right]
        done, phrase = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lot in _lots(several + 1, ENTRIES):
            row = np.repeat(np.arange(lot.start, lot.stop), several[lot])
            on, number = self.all.whole.of(head[row] * self.all.lasts + values[_laid_out(start[right[lot]], several[lot])])
            done.append(row[on])
            phrase.append(number)
        middle = self.middle[right]
        some = np.flatnonzero(middle >= 0)
        on, longer = self.all.onward.of(head[some] * len(self.all.middles) + middle[some])
        return owner[np.concatenate(done)], np.concatenate(phrase), owner[some[on]], longer

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each pair of neighbouring words the phrases of two parts, and the heads of longer ones."""
        start, count, values = self.first
        none = np.zeros(0, np.int64)
        parts = [(none, none, none, none)]
        for lot in _lots(count[left] * (1 + self.last[1][right]), ENTRIES):
            several = count[left[lot]]
            pair = np.repeat(np.arange(lot.start, lot.stop), several)
            parts.append(self._onward(pair, values[_laid_out(start[left[lot]], several)], right[pair]))
        return tuple(map(np.concatenate, zip(*parts)))

    def _words(self, words: pa.Array) -> None:
        """Look the distinct words up."""
        size, every = len(words), self.all
        data, places = _bytes(words)
        length, word = np.diff(places), np.arange(size)
        apart = np.full(int(length.sum()) + size + 1, ord(" "), np.uint8)
        begin = 1 + np.cumsum(length + 1) - (length + 1)
        letters = _laid_out(begin, length)
        apart[letters] = data[places[0] : places[-1]]
        start, count, inside = every.inside.found(apart, letters, np.repeat(word, length), size)
        self.inside = start, count, every.alone[inside]
        self.first = every.ending.found(apart, begin + length - 1, word, size, -1)
        self.last = every.beginning.found(apart, begin, word, size)
        middle = pc.index_in(words, value_set=every.middles) if len(every.middles) else pa.nulls(size, pa.int32())
        self.middle = middle.fill_null(-1).to_numpy().astype(np.int64)

    def _add(self, texts: pa.Array) -> None:
        parts = pc.split_pattern(texts, b" ")
        coded = parts.flatten().dictionary_encode()
        word = coded.indices.to_numpy().astype(np.int64)
        text = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
        words = len(coded.dictionary)
        self._words(coded.dictionary)
        self._count(len(texts), text, word, self.inside)
        at = np.flatnonzero((text[1:] == text[:-1]) & (self.first[1][word[:-1]] > 0))
        pairs, pair = np.unique(word[at] * words + word[at + 1], return_inverse=True)
        owner, number, longer, head = self._pairs(pairs // words, pairs % words)
        self._count(len(texts), text[at], pair, _lists(owner, number, len(pairs)))
        if len(longer):
            self._longer(text, word, at, pair, _lists(longer, head, len(pairs)))

    def _longer(self, text: np.ndarray, word: np.ndarray, at: np.ndarray, pair: np.ndarray, heads: Lists) -> None:
        """Phrases of three parts and more, from the pairs whose second word is a part between."""
        start, count, values = heads
        several = count[pair]
        place, head = np.repeat(at + 1, several), values[_laid_out(start[pair], several)]
        size = len(self.counts)
        found = [np.zeros(0, np.int64)]
        while len(place):
            on = np.flatnonzero(place + 1 < len(word))
            on = on[text[place[on] + 1] == text[place[on]]]
            place, head = place[on] + 1, head[on]
            owner, number, place, head = self._onward(place, head, word[place])
            found.append(_distinct(text[owner] * size + number))
        self.counts += np.bincount(_distinct(np.concatenate(found)) % size, minlength=size)

    def add(self, texts: pa.Array) -> None:
        """Count these texts; a null holds nothing."""
        texts = texts.drop_null().cast(pa.large_binary())
        for lot in _lots(pc.binary_length(texts).to_numpy(), TEXT_BYTES):
            self._add(texts.slice(lot.start, lot.stop - lot.start))

    def found(self) -> Iterator[pa.RecordBatch]:
        """(phrase, n) of the phrases that were found."""
        found = np.flatnonzero(self.counts)
        for lot in _lots(pc.binary_length(self.all.phrases).to_numpy()[found] + 64, ENTRIES):
            part = found[lot]
            names = self.all.phrases.take(pa.array(part)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(self.counts[part])], ["phrase", "n"])
