"""Weighted acyclic automata over words: phrases with counts, sharing prefixes and equal ends."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

Phrase = tuple[bytes, ...]


class Transducer:
    """Maps each of its phrases to a count, the weight of the state where the phrase ends.

    States that have the same weight and the same arcs are one state. They are numbered from the ends, so the
    start is the last one. ``arcs[s]`` are (word, state), in order of the words.
    """

    def __init__(self, weights: list[int], arcs: list[tuple[tuple[bytes, int], ...]]) -> None:
        self.weights, self.arcs = weights, arcs

    @classmethod
    def of(cls, counted: Iterable[tuple[Phrase, int]]) -> Transducer:
        """Built in one pass over sorted distinct phrases: a state is finished, and looked up, once no later phrase can run through it."""
        known: dict[tuple, int] = {}
        weights: list[int] = []
        arcs: list[tuple] = []
        # The states of the phrase before: their weights, and their arcs so far.
        heavy, out, last = [0], [[]], ()

        def close(depth: int) -> None:
            for k in range(len(last) - 1, depth - 1, -1):
                key = heavy.pop(), tuple(out.pop())
                at = known.get(key)
                if at is None:
                    at = known[key] = len(weights)
                    weights.append(key[0])
                    arcs.append(key[1])
                out[-1].append((last[k], at))

        for phrase, count in counted:
            shared = 0
            for one, other in zip(last, phrase, strict=False):
                if one != other:
                    break
                shared += 1
            close(shared)
            for _ in phrase[shared:]:
                heavy.append(0)
                out.append([])
            heavy[-1] += count
            last = phrase
        close(0)
        # The start is never shared, or it would not be the last state.
        weights.append(heavy[0])
        arcs.append(tuple(out[0]))
        return cls(weights, arcs)

    def items(self) -> Iterator[tuple[Phrase, int]]:
        """The phrases in order."""
        stack = [((), len(self.weights) - 1)]
        while stack:
            phrase, state = stack.pop()
            if self.weights[state]:
                yield phrase, self.weights[state]
            stack.extend((phrase + (word,), target) for word, target in reversed(self.arcs[state]))

    def compose(self, wanted: Transducer) -> Iterator[tuple[Phrase, int]]:
        """The counts of those phrases that ``wanted`` has too: both automata are walked together."""
        stack = [((), len(self.weights) - 1, len(wanted.weights) - 1)]
        while stack:
            phrase, state, other = stack.pop()
            if self.weights[state] and wanted.weights[other]:
                yield phrase, self.weights[state]
            there = dict(self.arcs[state])
            stack.extend((phrase + (word,), there[word], target) for word, target in wanted.arcs[other] if word in there)

    def pack(self) -> bytes:
        """Words must hold no space."""
        words = sorted({word for arcs in self.arcs for word, _ in arcs})
        place = {word: k for k, word in enumerate(words)}
        table = b" ".join(words)
        flat = [(place[word], target) for arcs in self.arcs for word, target in arcs]
        numbers = [
            np.array([len(self.weights), len(flat), len(table)], np.int64),
            np.array(self.weights, np.int64),
            np.array([len(arcs) for arcs in self.arcs], np.int32),
            np.array(flat, np.int32).reshape(-1, 2),
        ]
        return b"".join([n.tobytes() for n in numbers] + [table])

    @classmethod
    def unpack(cls, data: bytes) -> Transducer:
        states, flat, size = np.frombuffer(data, np.int64, 3).tolist()
        weights = np.frombuffer(data, np.int64, states, 24)
        counts = np.frombuffer(data, np.int32, states, 24 + 8 * states)
        pairs = np.frombuffer(data, np.int32, 2 * flat, 24 + 12 * states).reshape(-1, 2)
        words = data[len(data) - size :].split(b" ") if flat else []
        ends = np.cumsum(counts).tolist()
        every = [(words[w], t) for w, t in pairs.tolist()]
        return cls(weights.tolist(), [tuple(every[e - c : e]) for e, c in zip(ends, counts.tolist(), strict=True)])


def union(automata: Iterable[Transducer], least: int = 1) -> Transducer:
    """One automaton with the sums of the counts; sums below ``least`` go."""
    sums: dict[Phrase, int] = {}
    for one in automata:
        for phrase, count in one.items():
            sums[phrase] = sums.get(phrase, 0) + count
    return Transducer.of(sorted((phrase, count) for phrase, count in sums.items() if count >= least))
