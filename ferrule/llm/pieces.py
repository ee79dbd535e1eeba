"""Encoding of whole texts by memorised pieces between clean spaces.

The byte-level pattern attaches one space to what follows it, so a space
between two non-blank characters always begins a new pre-token.  A text cut at
such spaces gives parts that are encoded independently of each other, and most
parts of a corpus repeat: each is encoded once a task, as long as it is in the
bounded memo.
"""

from __future__ import annotations

from collections.abc import Callable

MEMO_PARTS = 200_000
MEMO_CHARS = 48


def _clean(part: str) -> bool:
    return part != "" and not part[0].isspace() and not part[-1].isspace()


def _joined(parts: list[str]) -> list[str]:
    """Parts again, where a space beside a blank is no cut."""
    out, run = [], [parts[0]]
    for p in parts[1:]:
        last = run[-1]
        if last != "" and not last[-1].isspace() and p != "" and not p[0].isspace():
            out.append(" ".join(run))
            run = [p]
        else:
            run.append(p)
    out.append(" ".join(run))
    return out


class PieceMemo:
    """``encode_many`` takes strings and gives one value for each; ``values(text)`` gives the
    values of the text's parts in order (their sum or concatenation is the text's)."""

    def __init__(self, encode_many: Callable[[list[str]], list]):
        self.encode_many = encode_many
        self.memo: dict = {}

    def values(self, text: str) -> list:
        parts = text.split(" ")
        try:
            rest = list(map(self.memo.__getitem__, parts[1:]))
        except KeyError:
            return self._fill(parts)
        return [*self.encode_many(parts[:1]), *rest]

    def _fill(self, parts: list[str]) -> list:
        memo = self.memo
        if len(memo) > MEMO_PARTS:
            memo.clear()
        new = {p for p in parts[1:] if p not in memo}
        if not all(map(_clean, new)) or parts[0] == "" or parts[0][-1].isspace():
            parts = _joined(parts)
            new = {p for p in parts[1:] if p not in memo}
        order = list(new)
        got = dict(zip(order, self.encode_many([" " + p for p in order]), strict=True))
        memo.update((p, v) for p, v in got.items() if len(p) <= MEMO_CHARS and _clean(p))
        return [*self.encode_many(parts[:1]), *(got[p] if p in got else memo[p] for p in parts[1:])]
