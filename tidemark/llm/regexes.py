"""What any match of a regex must contain, for prefilters.

Reads the forms that scan rules use: characters and their escapes, classes, `.`, groups, alternatives, repeats and
look-arounds. Other forms are errors, so no rule is filtered by a guess.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

MOST = 64  # strings that a part may stand for and still be spelt out
_PLAIN = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\v"}


@dataclass(frozen=True)
class Chars:
    """One character of these; None: any of too many to list."""

    of: frozenset[str] | None


@dataclass(frozen=True)
class Run:
    items: tuple


@dataclass(frozen=True)
class Either:
    items: tuple


@dataclass(frozen=True)
class Repeat:
    item: Run
    least: int
    most: int | None  # None: any number


class _Reader:
    def __init__(self, text: str) -> None:
        self.text, self.at = text, 0

    def peek(self, n: int = 1) -> str:
        return self.text[self.at : self.at + n]

    def take(self, n: int = 1) -> str:
        got = self.peek(n)
        if len(got) < n:
            raise ValueError(f"{self.text!r} ends early")
        self.at += n
        return got

    def either(self) -> Run:
        found = [self.run()]
        while self.peek() == "|":
            self.take()
            found.append(self.run())
        return found[0] if len(found) == 1 else Run((Either(tuple(found)),))

    def run(self) -> Run:
        items: list = []
        while self.peek() not in ("", "|", ")"):
            items.append(self.repeated(self.one()))
        return Run(tuple(items))

    def one(self):
        c = self.take()
        if c == "(":
            empty = False
            if self.peek() == "?":
                self.take()
                kind = self.take(2) if self.peek() == "<" else self.take()
                if kind not in (":", "!", "=", "<!", "<="):
                    raise ValueError(f"group (?{kind} in {self.text!r}")
                empty = kind != ":"
            inner = self.either()
            if self.take() != ")":
                raise ValueError(f"open group in {self.text!r}")
            return Run(()) if empty else inner  # a look-around takes no characters
        if c == "[":
            return self.chars()
        if c == ".":
            return Chars(None)
        if c == "\\":
            return Chars(self.escape())
        if c in "*+?{^$":
            raise ValueError(f"{c} in {self.text!r}")
        return Chars(frozenset(c))

    def escape(self) -> frozenset[str] | None:
        c = self.take()
        if c == "x":
            return frozenset(chr(int(self.take(2), 16)))
        if c in _PLAIN:
            return frozenset(_PLAIN[c])
        if c in "dDwWsS":
            return None
        if c.isalnum():
            raise ValueError(f"\\{c} in {self.text!r}")
        return frozenset(c)

    def chars(self) -> Chars:
        rest = self.peek() == "^"
        if rest:
            self.take()
        found: set[str] | None = set()
        first = True
        while first or self.peek() != "]":
            first = False
            c = self.take()
            low = self.escape() if c == "\\" else frozenset(c)
            if self.peek() == "-" and self.peek(2)[1:] != "]":
                self.take()
                c = self.take()
                high = self.escape() if c == "\\" else frozenset(c)
                if not low or not high:
                    raise ValueError(f"range in {self.text!r}")
                low = frozenset(map(chr, range(ord(min(low)), ord(min(high)) + 1)))
            found = None if low is None or found is None else found | low
        self.take()
        return Chars(None if rest or found is None else frozenset(found))

    def repeated(self, item):
        c = self.peek()
        if c not in ("?", "*", "+", "{") or not c:
            return item
        self.take()
        least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(c, (0, 0))
        if c == "{":
            end = self.text.index("}", self.at)
            low, comma, high = self.take(end - self.at).partition(",")
            self.take()
            least = int(low or 0)
            most = int(high) if high else None if comma else least
        if self.peek() == "?":
            self.take()  # how much is tried first does not matter
        return Repeat(item if isinstance(item, Run) else Run((item,)), least, most)


def parsed(pattern: str) -> Run:
    reader = _Reader(pattern)
    out = reader.either()
    if reader.at != len(pattern):
        raise ValueError(f"group not open in {pattern!r}")
    return out


def spelt(item) -> set[str] | None:
    """All strings (lower case) that a part can match, if they are few; else None."""
    if isinstance(item, Chars):
        found = item.of and {c.lower() for c in item.of}
        return found if found and len(found) <= 8 else None
    if isinstance(item, Either):
        own = [spelt(x) for x in item.items]
        if None in own:
            return None
        found = set().union(*own)
        return found if len(found) <= MOST else None
    if isinstance(item, Repeat):
        once = spelt(item.item) if item.most is not None and item.most <= 2 else None
        if once is None or len(once) ** item.most > MOST:
            return None
        return {"".join(p) for n in range(item.least, item.most + 1) for p in product(once, repeat=n)}
    run = {""}
    for x in item.items:
        own = spelt(x)
        if own is None or len(run) * len(own) > MOST:
            return None
        run = {a + b for a in run for b in own}
    return run


def one_of(pattern: str) -> frozenset[str]:
    """Strings (lower case) of which any match of the pattern holds at least one, as long as can be; empty if none are known."""
    return _best(parsed(pattern))


def _best(part: Run) -> frozenset[str]:
    found: list[frozenset[str]] = []
    run = {""}

    def end() -> None:
        if "" not in run:
            found.append(frozenset(s for s in run if not any(t in s and t != s for t in run)))

    for item in part.items:
        own = spelt(item)
        if own is not None and len(run) * len(own) <= MOST:
            run = {a + b for a in run for b in own}
            continue
        end()
        run = own if own is not None else {""}
        if isinstance(item, Run):
            found.append(_best(item))
        elif isinstance(item, Either):
            each = [_best(x) for x in item.items]
            found.append(frozenset().union(*each) if all(each) else frozenset())
        elif isinstance(item, Repeat) and item.least > 0:
            found.append(_best(item.item))
    end()
    return max((f for f in found if f), key=lambda f: (min(map(len, f)), -len(f)), default=frozenset())
