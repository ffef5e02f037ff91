"""Per-document text quality statistics and a prose / list / table / junk class.

A document longer than ``chunk_chars`` is cut into chunks, never inside a line end. Each chunk
yields a small state of additive counts plus what is open at its two ends: the first and last line
fragment, the first and last word fragment and two characters on either side. Merging two
neighbouring states is associative and exact: it closes the line and the word that cross the cut
and adds the patterns that span it, so any tree of merges gives the figures of the whole text.
Every pattern is counted by the places where it begins, whatever was matched before, and fragments
carry hashes that compose, so that no count depends on where a text was cut.
Short documents are one chunk and skip the shuffle. Counting runs in Arrow batches on vectorized
string kernels: all lines, or all words, of a batch are one column.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir, written

# Common function words of the languages looked for.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which you were her all she there would their we him been has when who will no more if out so what up its about into than them can only other new some could time these two may then do first any my now such like our over me even most made after did many before must through back where much your way well down should because each just those people how too little state good very make world still own see men work long here get both between life being under never day same another know while last might us great old year off come since against go came right used take three".split(),
    "fr": "le la les un une des du de et en au aux est dans pour que qui ne pas sur se ce cette il elle avec son sa ses par plus sont nous vous ils on mais ou leur à été après sans depuis chaque tout toute".split(),
    "es": "el la los las un una de del y en al es para que por con su sus se no lo como más pero este esta a después sin todo toda ha son fue está hasta cada durante muy o desde".split(),
}
# Words of page furniture.
PAGE_WORDS = "skip content privacy accept contact print back top next prev subscribe share login menu home about cart search cookies donate faq tickets season copyright rights reserved sitemap sign register newsletter".split()
TERMINALS = ".!?…。؟\"»”'’)]:;"


LINE_END = r"\r\n|[\n\r\x{0085}\x{2028}\x{2029}]"
BULLET = r"^(?:[-*•·–—▪◦‣+]|\(?[0-9]{1,4}[.)\]:]|\(?[A-Za-z][.)])[ \t\f]"
PAIR = r"^\pL(?:[\pL _-]{0,23}\pL)?:(?: |$)"
SYMBOL = r"[^\pL\pN\pM\s\x0b.,;:!?'\"’“”«»()-]"
#: Letters of a line that are kept to tell bullets and ``key: value`` pairs.
HEAD = 40
#: Different lines, or words, that are told apart exactly; beyond it their number is estimated from the smallest hashes.
VARIETY = 64

LINE_SUMS = ("lines", "blanks", "short_lines", "pair_lines", "pair_chars", "ended", "list_lines", "table_lines", "marked_lines", "list_chars", "table_chars", "prose_chars")
WORD_SUMS = ("words", "word_chars", "common", "page", "single")
GRAMS = ("semis", "slashes", "commas", "dots", "broken", "masked", "code")
BODY_SUMS = ("n_chars", "spaces", "symbols", "digits", "rare_letters")
SUMS = (*BODY_SUMS, *LINE_SUMS, *WORD_SUMS, *GRAMS)
VARIETIES = ("line_variety", "word_variety")
#: Counts of characters in a line, by name; each looks at no more than three neighbours.
LINE_GRAMS = ("tabs", "pipes", "line_semis", "line_commas", "gaps")


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the rule outcomes; shares are of characters unless said otherwise."""

    symbols: float = 0.25
    masked: float = 0.02
    broken: float = 0.015
    code: float = 0.04
    single: float = 0.55
    word_length: float = 11.0
    rare_letters: float = 0.07
    common: float = 0.12
    page: float = 0.45
    structure: float = 0.5
    short_line: int = 48
    brief_line: int = 36
    inline_words: float = 6.0



# --- counts of whole columns of texts -------------------------------------------------------
# Characters below 128 are looked for among the bytes of all texts of a column at once; a place is
# then given to the text it lies in.

_BROKEN = regex.compile(r"[ÃÂ](?=[\p{L}\p{P}\p{S} ])|â€")
_MASKED = regex.compile(r"(?<=\p{L})[#^|~@$10*](?=[\p{L}#^|~1])")


def _set(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_SPACE, _DIGIT, _RARE, _CODE, _MASK, _GAP = (_set(c) for c in (b" ", b"0123456789", b"jqxzJQXZ", b"{}<>=", b"#^|~@$10*", b" \t\n\x0b\f\r"))
_LETTER = _set(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_HIDDEN = _set(b"#^|~1") | _LETTER
_AFTER_AND = _set(b"#abcdefghijklmnopqrstuvwxyz")
_ASCII_WORD = _set(bytes([*range(48, 58), *range(65, 91), *range(97, 123)]))


def _np(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.int64)


class _Bytes:
    """The bytes of a column of texts; two zero bytes stand after the last."""

    def __init__(self, texts: pa.Array):
        at = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        self.at, self.raw = at - at[0], np.concatenate([raw, np.zeros(2, np.uint8)])
        self.n, self.size = len(texts), len(raw)

    def places(self, marked: np.ndarray) -> np.ndarray:
        return np.flatnonzero(marked[: self.size])

    def owner(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, places, side="right") - 1

    def counted(self, places: np.ndarray, reach: int = 0) -> np.ndarray:
        """How many of the places lie in each text, with the ``reach`` bytes after them."""
        owner = self.owner(places)
        if reach:
            owner = owner[places + reach < self.at[owner + 1]]
        return np.bincount(owner, minlength=self.n).astype(np.int64)

    def marks(self, char: str, after: np.ndarray) -> np.ndarray:
        """Places of a character before one of a set."""
        places = self.places(self.raw == ord(char))
        return places[after[self.raw[places + 1]]]


def _where(texts: pa.Array, marked: np.ndarray, count) -> np.ndarray:
    """``count`` of the texts that are marked, 0 for the others."""
    out = np.zeros(len(texts), dtype=np.int64)
    at = np.flatnonzero(marked)
    if len(at):
        out[at] = count(texts.take(pa.array(at)))
    return out


def _found(pattern):
    return lambda texts: np.array([sum(1 for _ in pattern.finditer(t)) for t in texts.to_pylist()], dtype=np.int64)


def gram_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts of patterns of up to three characters."""
    b = _Bytes(texts)
    raw = b.raw
    slashes = b.marks("/", _SPACE)
    slashes = slashes[(slashes > 0) & (raw[slashes - 1] == 32)]
    slashes = slashes[b.owner(slashes) == b.owner(np.maximum(slashes - 1, 0))]
    stops = b.places((raw == 46) | (raw == 33) | (raw == 63))
    dots = b.counted(stops[_GAP[raw[stops + 1]]], 1)
    if (raw == 0xE2).any():
        dots += _np(pc.count_substring_regex(texts, "…[ \\t\\n\\x0b\\f\\r]"))
    # texts that may hold what the patterns look for, by bytes
    inner = b.places(_MASK[raw])
    inner = inner[(inner > 0) & _LETTER[raw[np.maximum(inner - 1, 0)]] & _HIDDEN[raw[inner + 1]]]
    odd = b.places(raw == 0xC3)
    odd = odd[np.isin(raw[odd + 1], (0x82, 0x83, 0xA2))]
    calls = b.places(raw == 40)
    return {
        "semis": b.counted(b.marks(";", _SPACE), 1), "slashes": b.counted(slashes, 1), "commas": b.counted(b.marks(",", _SPACE), 1), "dots": dots,
        "broken": _where(texts, b.counted(odd), _found(_BROKEN)), "masked": _where(texts, b.counted(inner), _found(_MASKED)),
        "code": b.counted(b.places(_CODE[raw])) + b.counted(b.marks("&", _AFTER_AND), 1) + b.counted(calls[raw[calls + 1] == 41], 1),
    }


def line_gram_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    b = _Bytes(texts)
    space = b.raw == 32
    gaps = b.places(~space[:-2] & space[1:-1] & space[2:])
    return {
        "tabs": b.counted(b.places(b.raw == 9)), "pipes": b.counted(b.places(b.raw == 124)), "line_semis": b.counted(b.marks(";", ~_SPACE), 1),
        "line_commas": b.counted(b.marks(",", ~_SPACE), 1), "gaps": b.counted(gaps, 2),
    }


_WORD_POINTS: dict[int, bool] = {}


def _word_bytes(b: _Bytes) -> np.ndarray:
    """Marks the bytes of letters, numbers and combining marks."""
    word = _ASCII_WORD[b.raw]
    high = b.raw >= 0xC0
    if high.any():
        lead = b.places(high)
        first = b.raw[lead].astype(np.int64)
        size = np.select([first < 0xE0, first < 0xF0], [2, 3], 4)
        padded = np.concatenate([b.raw, np.zeros(2, np.uint8)]).astype(np.int64)
        point = np.select([size == 2, size == 3], [first & 0x1F, first & 0x0F], first & 0x07)
        for step in (1, 2, 3):
            point = np.where(step < size, (point << 6) | (padded[lead + step] & 0x3F), point)
        known, where = np.unique(point, return_inverse=True)
        for p in known:
            if int(p) not in _WORD_POINTS:
                _WORD_POINTS[int(p)] = unicodedata.category(chr(int(p)))[0] in "LNM"
        inside = np.array([_WORD_POINTS[int(p)] for p in known])[where]
        for step in (0, 1, 2, 3):
            some = inside & (step < size)
            word[lead[some] + step] = True
    word[b.size :] = False
    return word


def _runs(b: _Bytes, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word; a word never spans two texts."""
    begins = np.zeros(b.size + 1, dtype=bool)
    begins[b.at] = True
    inside, before = word[: b.size], np.concatenate([[False], word[: max(b.size - 1, 0)]])[: b.size]
    start = np.flatnonzero(inside & (~before | begins[: b.size]))
    end = np.flatnonzero(inside & (~word[1 : b.size + 1] | begins[1:])) + 1
    return start, end


def _strings(b: _Bytes, start: np.ndarray, end: np.ndarray, word: np.ndarray) -> pa.Array:
    """The words as a column."""
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(b.raw[: b.size][word[: b.size]])))


def judged_lines(head: pa.Array, end: pa.Array, n: np.ndarray, grams: dict[str, np.ndarray], rules: QualityRules) -> dict[str, np.ndarray]:
    """What each whole line adds to the sums, from its beginning, last letter, length and counts."""
    among = lambda chars: pc.is_in(end, value_set=pa.array(list(chars), end.type)).to_numpy(zero_copy_only=False)
    hit = lambda pattern, guard: _where(head, guard.to_numpy(zero_copy_only=False), lambda t: _np(pc.match_substring_regex(t, pattern))) > 0
    blank = pc.equal(end, "").to_numpy(zero_copy_only=False)
    cells = (grams["pipes"] >= 2) | (grams["tabs"] >= 2) | ((n <= 240) & ((grams["line_semis"] >= 2) | (grams["line_commas"] >= 2) | (grams["gaps"] >= 2)))
    marked = pc.match_substring_regex(head, BULLET).to_numpy(zero_copy_only=False) & ~blank
    pair = hit(PAIR, pc.match_substring(head, ":")) & (n <= 60) & ~among(".!?")
    item = (n <= rules.short_line) & ~(among(".?…") & (n > 12))
    kind = np.select([blank, cells, pair & ~marked, (marked & (n <= 120)) | item], [0, 1, 2, 3], 4)
    told = kind > 0
    size = lambda k: np.where(kind == k, n, 0)
    return {
        "lines": told, "blanks": ~told, "short_lines": told & (n <= rules.brief_line), "pair_lines": kind == 2, "pair_chars": size(2), "ended": told & among(TERMINALS), "list_lines": kind == 3,
        "table_lines": kind == 1, "marked_lines": marked, "list_chars": size(3), "table_chars": size(1), "prose_chars": size(4),
    }


def judged_words(words: pa.Array, n: np.ndarray) -> dict[str, np.ndarray]:
    """What each whole word, in lower case, adds to the sums; an empty one adds nothing."""
    common = pa.array(sorted({w for some in COMMON_WORDS.values() for w in some}), words.type)
    among = lambda known: pc.is_in(words, value_set=known).to_numpy(zero_copy_only=False)
    return {"words": n > 0, "word_chars": n, "common": among(common), "page": among(pa.array(PAGE_WORDS, words.type)), "single": n == 1}


# --- hashes that compose: of two texts in a row, h(a) + BASE ** bytes(a) * h(b) ---------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WRAP = (1 << 64) - 1
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_POWERS.get(base, ())) < n:
        with np.errstate(over="ignore"):
            table = np.full(1 << max(16, int(n - 1).bit_length()), base, dtype=np.uint64)
            table[0] = 1
            _POWERS[base] = np.multiply.accumulate(table)
    return _POWERS[base][:n]


def _hashes(texts: pa.Array) -> np.ndarray:
    b = _Bytes(texts)
    with np.errstate(over="ignore"):
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.raw[: b.size].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, b.size + 1)[: b.size], dtype=np.uint64)])
        return (running[b.at[1:]] - running[b.at[:-1]]) * _powers(_INVERSE, b.size + 1)[b.at[:-1]]


def _mixed(h: np.ndarray) -> np.ndarray:
    """Evenly spread over 64 bits."""
    with np.errstate(over="ignore"):
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
        return h ^ (h >> np.uint64(31))


def _smallest(owner: np.ndarray, code: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each owner the ``VARIETY`` smallest different hashes, owner by owner, and how many they are.

    ``code`` is the position in ``hashes`` of each item's hash.
    """
    order, rank = np.unique(hashes, return_inverse=True)
    width = max(1, len(order))
    key = np.sort(owner * width + rank[code])
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    owner = key // width
    count = np.bincount(owner, minlength=n)
    keep = np.arange(len(owner)) - (np.cumsum(count) - count)[owner] < VARIETY
    return order[(key - owner * width)[keep]] if len(key) else order, np.minimum(count, VARIETY)


def _variety(count: int, largest: int) -> int:
    """Different values of which the ``count`` smallest hashes are kept, the largest of them ``largest``."""
    return count if count < VARIETY else round((VARIETY - 1) * 2.0**64 / (float(largest) + 1.0))


# --- states of pieces of text, and their merge -----------------------------------------------


def _line_piece(text: str) -> dict:
    column = pa.array([text], pa.string())
    bare = text.lstrip(" ")
    return {
        "n": len(text), "pad": min(len(text) - len(bare), HEAD), "head": bare[:HEAD], "end": text.rstrip(" ")[-1:], "first": text[:2], "last": text[-2:],
        "hash": int(_hashes(column)[0]), "bytes": len(text.encode()), **{k: int(v[0]) for k, v in line_gram_counts(column).items()},
    }


def _word_piece(text: str) -> dict:
    # words under 32 letters are looked up; longer ones are only counted
    return {"n": len(text), "text": text[:32], "hash": int(_hashes(pa.array([text], pa.string()))[0]), "bytes": len(text.encode())}


def _across(count, a: str, b: str) -> dict[str, int]:
    """Matches that only exist across the seam of ``a`` and ``b``, the two letters on either side."""
    c = count(pa.array([a + b, a, b], pa.string()))
    return {k: int(v[0] - v[1] - v[2]) for k, v in c.items()}


def _joined_hash(a: dict, b: dict) -> dict:
    return {"hash": (a["hash"] + pow(_BASE, a["bytes"], 1 << 64) * b["hash"]) & _WRAP, "bytes": a["bytes"] + b["bytes"]}


def _joined_lines(a: dict, b: dict) -> dict:
    seam = _across(line_gram_counts, a["last"], b["first"])
    bare = a["head"] == ""
    return {
        "n": a["n"] + b["n"], "pad": min(a["pad"] + b["pad"], HEAD) if bare else a["pad"], "head": b["head"] if bare else (a["head"] + " " * b["pad"] + b["head"])[:HEAD], "end": b["end"] or a["end"],
        "first": (a["first"] + b["first"])[:2], "last": (a["last"] + b["last"])[-2:], **_joined_hash(a, b), **{k: a[k] + b[k] + seam[k] for k in LINE_GRAMS},
    }


def _joined_words(a: dict, b: dict) -> dict:
    return {"n": a["n"] + b["n"], "text": (a["text"] + b["text"])[:32], **_joined_hash(a, b)}


def _add(sums: dict[str, int], more: dict) -> None:
    for k, v in more.items():
        sums[k] += int(v)


def _close_line(state: dict, piece: dict, rules: QualityRules) -> None:
    one = lambda k: pa.array([piece[k]], pa.string())
    counts = judged_lines(one("head"), one("end"), np.array([piece["n"]]), {k: np.array([piece[k]]) for k in LINE_GRAMS}, rules)
    _add(state["sums"], {k: v[0] for k, v in counts.items()})
    if piece["end"]:
        state["line_hashes"] = _merged_hashes(state["line_hashes"], [int(_mixed(np.array([piece["hash"]], np.uint64))[0])])


def _close_word(state: dict, piece: dict) -> None:
    text = pa.array([piece["text"] if piece["n"] < 32 else ""], pa.string())
    _add(state["sums"], {k: v[0] for k, v in judged_words(text, np.array([piece["n"]])).items()})
    if piece["n"]:
        state["word_hashes"] = _merged_hashes(state["word_hashes"], [int(_mixed(np.array([piece["hash"]], np.uint64))[0])])


def _merged_hashes(a: list[int], b: list[int]) -> list[int]:
    return sorted({*a, *b})[:VARIETY]


def merged(a: dict, b: dict, rules: QualityRules) -> dict:
    """The state of two neighbouring pieces of text; associative."""
    out = {"sums": {k: a["sums"][k] + b["sums"][k] for k in SUMS}, "first": (a["first"] + b["first"])[:2], "last": (a["last"] + b["last"])[-2:]}
    _add(out["sums"], _across(gram_counts, a["last"], b["first"]))
    for kind in ("line", "word"):
        out[f"{kind}_hashes"] = _merged_hashes(a[f"{kind}_hashes"], b[f"{kind}_hashes"])
    for kind, joined, close in (("line", _joined_lines, lambda x: _close_line(out, x, rules)), ("word", _joined_words, lambda x: _close_word(out, x))):
        head, tail = f"{kind}_head", f"{kind}_tail"
        seam = joined(a[head] if a[tail] is None else a[tail], b[head])
        out[head] = seam if a[tail] is None else a[head]
        if b[tail] is None:
            out[tail] = None if a[tail] is None else seam
        else:
            out[tail] = b[tail]
            if a[tail] is not None:
                close(seam)
    return out


def closed(state: dict, rules: QualityRules) -> dict[str, int]:
    """Figures of a whole text: its first and last line and word are complete."""
    for kind, close in (("line", lambda x: _close_line(state, x, rules)), ("word", lambda x: _close_word(state, x))):
        for end in ("head", "tail"):
            if state[f"{kind}_{end}"] is not None:
                close(state[f"{kind}_{end}"])
    variety = {f"{k}_variety": _variety(len(h), h[-1] if h else 0) for k, h in (("line", state["line_hashes"]), ("word", state["word_hashes"]))}
    return state["sums"] | variety


def measured(bodies: pa.Array, rules: QualityRules, *, whole: bool) -> tuple[dict[str, np.ndarray], list[dict]]:
    """Sums of each text. With ``whole`` its first and last line and word count; else they are left open in the states."""
    b = _Bytes(bodies)
    n = b.n
    sums: dict[str, np.ndarray] = {"n_chars": _np(pc.utf8_length(bodies)), "symbols": _np(pc.count_substring_regex(bodies, SYMBOL))}
    sums |= {name: b.counted(b.places(kind[b.raw])) for name, kind in (("spaces", _SPACE), ("digits", _DIGIT), ("rare_letters", _RARE))}
    sums |= gram_counts(bodies)
    add = lambda owner, counts: sums.update({k: np.bincount(owner, weights=v, minlength=n).astype(np.int64) for k, v in counts.items()})
    # lines
    split = pc.split_pattern_regex(bodies, LINE_END)
    lines, owner, ends = split.flatten(), _np(pc.list_parent_indices(split)), split.offsets.to_numpy().astype(np.int64)
    inner = np.ones(len(lines), dtype=bool)
    if not whole:
        inner[ends[:-1]] = inner[ends[1:] - 1] = False
    last = pc.utf8_slice_codeunits(pc.utf8_rtrim(lines, " "), -1)
    counts = judged_lines(pc.utf8_slice_codeunits(pc.utf8_ltrim(lines, " "), 0, HEAD), last, _np(pc.utf8_length(lines)), line_gram_counts(lines), rules)
    add(owner[inner], {k: v[inner] for k, v in counts.items()})
    some = np.flatnonzero(inner & (pc.not_equal(last, "").to_numpy(zero_copy_only=False)))
    hashes = {"line": _smallest(owner[some], some, _mixed(_hashes(lines)), n)}
    # words
    low = _Bytes(pc.utf8_lower(bodies))
    marked = _word_bytes(low)
    start, end = _runs(low, marked)
    words, owner = _strings(low, start, end, marked), low.owner(start)
    known = words.dictionary_encode()
    code, known = known.indices.to_numpy(zero_copy_only=False).astype(np.int64), known.dictionary
    inner = np.ones(len(words), dtype=bool) if whole else (start != low.at[owner]) & (end != low.at[owner + 1])
    code, owner = code[inner], owner[inner]
    add(owner, {k: v[code] for k, v in judged_words(known, _np(pc.utf8_length(known))).items()})
    hashes["word"] = _smallest(owner, code, _mixed(_hashes(known)), n)
    if whole:
        for kind, (h, count) in hashes.items():
            most = np.concatenate([h, np.zeros(1, np.uint64)])[np.maximum(np.cumsum(count) - 1, 0)]
            sums[f"{kind}_variety"] = np.array([_variety(int(c), int(x)) for c, x in zip(count, most)], dtype=np.int64)
        return sums, []
    states = []
    for i, body in enumerate(bodies.to_pylist()):
        parts = {"line": lines[int(ends[i]) : int(ends[i + 1])], "word": regex.split(r"[^\p{L}\p{N}\p{M}]+", body.lower())}
        state = {"sums": {k: int(sums[k][i]) for k in SUMS}, "first": body[:2], "last": body[-2:]}
        for kind, piece in (("line", _line_piece), ("word", _word_piece)):
            h, count = hashes[kind]
            upto = int(count[: i + 1].sum())
            state[f"{kind}_hashes"] = [int(x) for x in h[upto - int(count[i]) : upto]]
            ends_ = [str(parts[kind][0]), str(parts[kind][len(parts[kind]) - 1]) if len(parts[kind]) > 1 else None]
            state[f"{kind}_head"], state[f"{kind}_tail"] = piece(ends_[0]), None if ends_[1] is None else piece(ends_[1])
        states.append(state)
    return sums, states


# --- Spark ------------------------------------------------------------------------------------

#: States merged by one node of the tree, as a shift.
FAN_SHIFT = 8
#: Bytes of text that kernels take at a time.
SLICE_BYTES = 1 << 20


def _slices(bodies: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    at, start = np.frombuffer(bodies.buffers()[1], dtype=np.int32)[bodies.offset : bodies.offset + len(bodies) + 1], 0
    while start < len(bodies):
        end = max(start + 1, int(np.searchsorted(at, at[start] + SLICE_BYTES, side="right")) - 1)
        yield start, pa.concat_arrays([bodies.slice(start, end - start)])
        start = end


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("body").cast(pa.string())


def clean_text(text: Column) -> Column:
    """Odd spaces become plain ones; zero-width characters and a byte-order mark go."""
    odd = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
    given = F.coalesce(text, F.lit(""))
    tidy = F.translate(given, odd + "\u200b\u200c\u200d\u2060\ufeff\u00ad", " " * len(odd))
    return F.when(given.rlike("[\\u00a0\\u00ad\\u1680\\u2000-\\u200d\\u202f\\u205f\\u2060\\u3000\\ufeff]"), tidy).otherwise(given)



def quality_statistics(
    docs: DataFrame, *, id: str = "doc_id", text: str = "text", chunk_chars: int = 1 << 13,
    max_chars: int = 1 << 31, rules: QualityRules = QualityRules(),
) -> DataFrame:
    """One row per row of ``docs``: its id, the additive counts and the ratios made of them.

    A null text counts as empty; an empty text has zero counts and zero ratios. Rows with a null
    id are kept, rows of a repeated id are measured each. Other columns are ignored.
    ``line_variety`` and ``word_variety`` are the numbers of different lines that are not blank and of
    different words, exact under ``VARIETY`` and estimated beyond.
    ``chunk_chars`` bounds what one task holds of a text and changes no figure; ``max_chars`` only sizes the tree.
    """
    chunk_chars = max(chunk_chars, 4)
    kind = docs.schema[id].dataType.simpleString()
    figures = (*SUMS, *VARIETIES)
    columns = f"id {kind}, " + ", ".join(f"{c} bigint" for c in figures)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for start, bodies in _slices(_texts(batch)):
                sums, _ = measured(bodies, rules, whole=True)
                yield pa.RecordBatch.from_arrays([ids.slice(start, len(bodies)), *(pa.array(sums[c], pa.int64()) for c in figures)], ["id", *figures])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, name, body in zip(batch.column("row"), batch.column("id"), _texts(batch)):
                body, at, part = body.as_py(), 0, 0
                while at < len(body):
                    end = min(len(body), at + chunk_chars)
                    end += body[end - 1 : end + 1] == "\r\n"
                    yield pa.RecordBatch.from_arrays([pa.array([row.as_py()], row.type), pa.array([name.as_py()], name.type), pa.array([part], pa.int64()), pa.array([body[at:end]], pa.string())], ["row", "id", "at", "body"])
                    at, part = end, part + 1

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, bodies in _slices(_texts(batch)):
                states = measured(bodies, rules, whole=False)[1]
                own = [batch.column(c).slice(start, len(bodies)) for c in ("row", "id", "at")]
                yield pa.RecordBatch.from_arrays([*own, pa.array([json.dumps(s) for s in states], pa.string())], ["row", "id", "at", "state"])

    def merge(group: pa.Table) -> dict:
        group = group.sort_by("at")
        total = None
        for state in group.column("state").to_pylist():
            state = json.loads(state)
            total = state if total is None else merged(total, state, rules)
        return total

    def node(key: tuple, group: pa.Table) -> pa.Table:
        keep = group.slice(0, 1)
        return pa.table({"row": keep.column("row"), "id": keep.column("id"), "at": pa.array([key[1].as_py()], pa.int64()), "state": pa.array([json.dumps(merge(group))], pa.string())})

    def root(key: tuple, group: pa.Table) -> pa.Table:
        got = closed(merge(group), rules)
        return pa.table({"id": group.slice(0, 1).column("id"), **{c: pa.array([got[c]], pa.int64()) for c in figures}})

    # parted by the raw length, before any cleaning
    raw = F.coalesce(F.length(F.col(text)), F.lit(0))
    tidy = lambda rows: rows.select(F.col(id).alias("id"), clean_text(F.col(text)).alias("body"))
    one = tidy(docs.filter(raw <= chunk_chars)).mapInArrow(whole, columns)
    pieces = tidy(docs.filter(raw > chunk_chars)).withColumn("row", F.monotonically_increasing_id()).filter(F.length("body") > 0)
    # a text of nothing but characters that cleaning takes away is empty
    void = tidy(docs.filter(raw > chunk_chars)).filter(F.length("body") == 0).mapInArrow(whole, columns)
    states = pieces.mapInArrow(cut, f"row bigint, id {kind}, at bigint, body string").repartition("row", "at").mapInArrow(leaves, f"row bigint, id {kind}, at bigint, state string")
    reach = chunk_chars << FAN_SHIFT
    while reach < max_chars:
        states = states.groupBy("row", F.shiftright("at", FAN_SHIFT).alias("up")).applyInArrow(node, f"row bigint, id {kind}, at bigint, state string")
        reach <<= FAN_SHIFT
    tree = states.groupBy("row").applyInArrow(root, columns)
    c = F.col
    share = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    solid = c("n_chars") - c("spaces")
    records = c("blanks") * 8 >= c("pair_lines")  # key: value lines in blocks are a table, else a list
    tables = c("table_chars") + F.when(records, c("pair_chars")).otherwise(0)
    lists = c("list_chars") + F.when(records, 0).otherwise(c("pair_chars"))
    body = lists + tables + c("prose_chars")
    return one.unionByName(tree).unionByName(void).select(
        c("id").alias(id), *SUMS, *VARIETIES,
        share(c("rare_letters"), c("word_chars")).alias("rare_letter_ratio"),
        share(c("word_chars"), c("words")).alias("mean_word_length"), share(c("symbols"), solid).alias("symbol_ratio"),
        share(c("digits"), solid).alias("digit_ratio"), share(c("common"), c("words")).alias("common_share"),
        share(c("page"), c("words")).alias("page_share"), share(c("single"), c("words")).alias("single_share"),
        share(c("ended"), c("lines")).alias("ended_share"), share(lists, body).alias("list_share"),
        share(tables, body).alias("table_share"), share(c("masked"), solid).alias("masked_ratio"),
        share(c("broken"), solid).alias("broken_ratio"), share(c("code"), solid).alias("code_ratio"),
        share(c("words"), c("semis") + c("slashes") + 1).alias("words_per_item"),
        share(c("words"), c("commas") + 1).alias("words_per_comma"), share(c("words"), c("dots") + 1).alias("words_per_sentence"),
    )


def text_class(rules: QualityRules = QualityRules()) -> Column:
    """``prose``, ``list``, ``table`` or ``junk`` from the statistics; a text without words or symbols is junk."""
    c = F.col
    blank = (c("words") == 0) & (c("symbols") == 0)
    noise = (c("symbol_ratio") > rules.symbols) & (c("table_share") < rules.structure)
    spaced = (c("single_share") > rules.single) & (c("table_share") < rules.structure)
    code = c("code_ratio") > rules.code
    typed = (c("rare_letter_ratio") > rules.rare_letters) & (c("common_share") < rules.common)
    page = c("page_share") > rules.page
    structured = c("list_share") + c("table_share") > rules.structure
    table = structured & (c("table_share") >= c("list_share"))
    marked = c("marked_lines") * 2 >= c("lines")
    rare = c("common_share") < rules.common
    series = (c("words_per_comma") < 6.5) & (c("commas") >= 3) & (c("commas") > 3 * c("dots"))
    items = (c("words_per_item") < rules.inline_words) | series
    brief = (c("lines") >= 4) & (c("short_lines") > 0.8 * c("lines"))
    loop = ((c("lines") >= 6) & (c("line_variety") <= 3)) | ((c("words") >= 24) & (c("word_variety") <= 8)) | (
        (c("words") >= 60) & (c("word_variety") <= 12))
    return (
        F.when(blank, "junk")
        .when(spaced & (c("words") > 5), "junk")
        .when(code, "junk").when(page, "junk").when(noise | typed | loop, "junk")
        .when(c("broken_ratio") > rules.broken, "junk").when(c("masked_ratio") > rules.masked, "junk")
        .when(table, "table")
        .when(structured & (marked | (c("list_lines") + c("pair_lines") >= 3)), "list").when(brief, "list")
        .when((c("mean_word_length") > rules.word_length), "junk")
        .when(items & ((c("words_per_sentence") > 12) | (c("dots") <= 1)), "list")
        .when(rare, "junk")
        .otherwise("prose")
    )


def classified(docs: DataFrame, *, id: str = "doc_id", text: str = "text", rules: QualityRules = QualityRules(), **options) -> DataFrame:
    """Id and ``text_class`` of each row of ``docs``.

    The statistics are written to the shared folder first: the class refers to each of them many
    times, and over a table the optimizer cannot repeat the counting in every place.
    """
    figures = quality_statistics(docs, id=id, text=text, rules=rules, **options)
    return written(figures, work_dir(docs.sparkSession), "quality").select(F.col(id), text_class(rules).alias("text_class"))
