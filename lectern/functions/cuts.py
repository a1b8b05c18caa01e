"""Ordered rules that cut a line into named pieces."""

from __future__ import annotations

import re
from dataclasses import dataclass

from lectern.functions import fixed

# A run of closing marks, and the patterns of the cut rules with the words that they look for.
CLOSING = r"[།༎](?:[\s་]*[།༎])*"
QUOTE_CLOSE = "ཞེས་སོ|ཅེས་སོ|ཞེས་གསུངས་སོ|ཞེས་བཤད་དོ|ཞེས་པའོ|ཅེས་པའོ|ཞེས་བྱ་བའོ"
QUOTE_OPEN = "ལས|གསུངས"
NUMBERS = "གཉིས|གསུམ|བཞི|ལྔ|དྲུག|བདུན|བརྒྱད|དགུ|བཅུ"
AFTER_NUMBERS = "ལས|སྟེ|སུ|དུ|ཡོད|ནས|པོ"
ORDINALS = "དང་པོ|གཉིས་པ|གསུམ་པ|བཞི་པ|ལྔ་པ|དྲུག་པ|བདུན་པ|བརྒྱད་པ|དགུ་པ|བཅུ་པ"
OBJECTION_CLOSE = "ཅེ་ན|ཞེ་ན|སྙམ་ན"
OBJECTION_OPEN = "འོ་ན་"
FINAL = ".འོ|[ནདསཏརངབམགལ]ོ"
# Fixed value: characters before a weak opener in which a closing mark must stand.
NEAR = 12


@dataclass(frozen=True)
class Rule:
    """Cuts before or after what a pattern finds. A weak one needs a closing mark near before it; ``marks`` is how many closing marks it needs where only structure counts (None: it doesn't count there)."""

    name: str
    side: str
    pattern: re.Pattern
    weak: bool = False
    marks: int | None = 0


#: In order: of two rules that cut at one place the first names the piece.
TIBETAN = (
    Rule("quote-close", "after", re.compile(f"(?:{QUOTE_CLOSE}){CLOSING}")),
    Rule("quote-open", "after", re.compile(f"(?:{QUOTE_OPEN}){CLOSING}")),
    Rule("enumeration-head", "after", re.compile(f"(?:{NUMBERS})་(?:{AFTER_NUMBERS}){CLOSING}"), marks=None),
    Rule("ordinal-open", "before", re.compile(f"(?:{ORDINALS})་")),
    Rule("objection-close", "after", re.compile(f"(?:{OBJECTION_CLOSE}){CLOSING}"), marks=None),
    Rule("objection-open", "before", re.compile(OBJECTION_OPEN), weak=True, marks=None),
    Rule("terminal-particle", "after", re.compile(f"(?:{FINAL}){CLOSING}"), marks=2),
)
GENERAL = (
    Rule("opening", "before", re.compile(r"(?:^|\s)(?=[#>])")),
    Rule("clause", "after", re.compile(r"།+\s*"), marks=2),
    Rule("sentence", "after", re.compile(r"[.!?]+[\"'”’)]*\s+")),
    Rule("semicolon", "after", re.compile(r"[;:]\s+"), marks=None),
)


class Line:
    """A text with what the rules ask of a place, each answered without a look at the whole text."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.end = len(text.rstrip())
        self.closings = [m.start() for m in re.finditer("[།༎]", text)]

    def may_cut(self, at: int) -> bool:
        """Inside the text, and not after a syllable mark, which stands within a phrase."""
        last = at - 1
        while last >= 0 and self.text[last].isspace():
            last -= 1
        return 0 < at < self.end and not (last >= 0 and self.text[last] == fixed.TSHEG)

    def closes_near(self, at: int) -> bool:
        return any(c in "།༎" for c in self.text[max(0, at - NEAR):at])

    def inside_brackets(self) -> list[bool]:
        out, depth = [], 0
        for c in self.text:
            out.append(depth > 0)
            depth = max(0, depth + (c in "([") - (c in ")]"))
        return out


@dataclass
class Cuts:
    """Places of cuts; the rule that names what begins there and what ends there; and places where a weak rule would cut."""

    begins: dict[int, str]
    ends: dict[int, str]
    candidates: list[tuple[int, str]]

    @property
    def places(self) -> list[int]:
        return sorted({*self.begins, *self.ends})


def cut(text: str, rules: tuple[Rule, ...] = GENERAL, structural: bool = False, in_brackets: bool = True) -> Cuts:
    """Cuts of a text by rules, each of which reads it once."""
    line, found = Line(text), Cuts({}, {}, [])
    closed = None if in_brackets else line.inside_brackets()
    for rule in rules:
        if structural and rule.marks is None:
            continue
        for m in rule.pattern.finditer(text):
            if structural and rule.marks and sum(c in "།༎" for c in m.group()) < rule.marks:
                continue
            at = m.end() if rule.side == "after" else m.start()
            if rule.side == "before" and at and text[at - 1] in "([":
                at -= 1
            if not line.may_cut(at) or (closed and closed[at]):
                continue
            if rule.weak and not line.closes_near(m.start()):
                found.candidates.append((at, rule.name))
            else:
                (found.ends if rule.side == "after" else found.begins).setdefault(at, rule.name)
    return found


def pieces(text: str, found: Cuts) -> list[tuple[int, int, str | None, str | None]]:
    """``(start, end, begins, ends)`` of each piece: the rules that name it on either side."""
    edges = [0, *found.places, len(text)]
    return [(a, b, found.begins.get(a), found.ends.get(b)) for a, b in zip(edges, edges[1:], strict=False) if a < b]
