"""Canonical forms of organization names, localities, titles and street addresses.

Plain Python on single strings, run in Arrow batches with a memory of tokens; the callers pass
distinct values. Correcting a misspelt type word needs an edit-distance lookup against a
vocabulary, which no built-in expression offers.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Words of legal form and of no meaning for identity.
NOISE = frozenset("the inc incorporated llc ltd limited corp corporation co company assn association society foundation of for at and le la les de du des el los a d l".split())
# Abbreviations of kinds of organization.
EXPAND = {
    "rep": "repertory", "cmty": "community", "comm": "community", "com": "community", "th": "theatre", "thtr": "theatre", "theater": "theatre", "thr": "theatre", "theatres": "theatre",
    "perf": "performing", "acad": "academy", "ctr": "center", "centre": "center", "mem": "memorial", "stg": "stage", "sch": "school", "elem": "elementary", "mid": "middle", "hse": "house",
    "dept": "department", "u": "university", "univ": "university", "lt": "light", "plyrs": "players", "yth": "youth", "cncl": "council", "playhse": "playhouse", "mus": "musical", "childrens": "children",
    "hs": "high school", "ms": "middle school", "clo": "civic light opera", "apa": "academy performing arts", "pac": "performing arts center", "es": "elementary", "jct": "junction", "hts": "heights", "ft": "fort", "twp": "township", "spgs": "springs", "mt": "mount", "st": "saint",
}
# Words that name a kind of organization.
TYPES = frozenset("repertory community theatre performing academy center memorial stage school elementary middle high house department university light players youth council playhouse musical children opera civic arts dance dinner pta drama club guild little grange".split()) - {"little", "grange"}
# Short forms of English given names.
NICKNAMES = {
    short: full
    for full, shorts in {
        "robert": "bob bobby rob robbie", "william": "bill billy will willie liam", "richard": "rick dick rich ricky", "james": "jim jimmy jamie", "charles": "chuck charlie charley", "edward": "ed eddie ned",
        "theodore": "theo teddy ted", "alexander": "alex alec sandy xander", "anthony": "tony", "benjamin": "ben benny benji", "samuel": "sam sammy", "daniel": "dan danny", "katherine": "kate kathy katie kay kat", "elizabeth": "liz beth betty eliza lizzie betsy",
        "margaret": "maggie peggy meg marge", "patricia": "pat patty tricia patsy", "deborah": "deb debbie debby", "rebecca": "becky becca", "susan": "sue susie suzy", "christine": "chris chrissy tina christy", "thomas": "tom tommy", "michael": "mike mick mickey",
        "joseph": "joe joey", "john": "jack johnny", "david": "dave davey", "matthew": "matt", "andrew": "andy drew", "jennifer": "jen jenny", "barbara": "barb", "dorothy": "dot dottie", "nicholas": "nick", "stephen": "steve", "gregory": "greg", "timothy": "tim", "lawrence": "larry", "ronald": "ron",
    }.items()
    for short in shorts.split()
}
GIVEN = frozenset(NICKNAMES.values())
# Parts of place names and their short forms.
PLACE = {
    "ft": "fort", "st": "saint", "ste": "sainte", "mt": "mount", "hts": "heights", "hgts": "heights", "twp": "township", "spgs": "springs", "spg": "springs", "sprgs": "springs", "jct": "junction", "jctn": "junction", "n": "north", "s": "south", "e": "east", "w": "west", "vlg": "village", "ctr": "center", "centre": "center",
}


def plain(text: str | None) -> str:
    """Lower case without accents."""
    if text and text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text or "")
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours as one edit, in a band of ``most``; ``most + 1`` beyond."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before = before, row
        row = [i] + [most + 1] * len(b)
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            cost = min(before[j - 1] + (x != y), before[j] + 1, row[j - 1] + 1)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row[j] = cost
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def deletions(word: str) -> set[str]:
    """The word and all forms that lack one letter."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


@lru_cache(1)
def _vocabulary() -> dict[str, list[str]]:
    index: dict[str, list[str]] = {}
    for word in sorted(TYPES | GIVEN):
        if len(word) >= 5:
            for form in deletions(word):
                index.setdefault(form, []).append(word)
    return index


@lru_cache(1 << 16)
def _token(word: str) -> str:
    """A token expanded, or corrected to the vocabulary word one edit away."""
    word = NICKNAMES.get(word, EXPAND.get(word, word))
    if len(word) < 5 or " " in word or word in TYPES or word in GIVEN:
        return word
    index = _vocabulary()
    for form in sorted(deletions(word), key=lambda f: -len(f)):
        for known in index.get(form, ()):
            if edits(word, known, 1) <= 1:
                return known
    return word


_DBA = re.compile(r"\bd\.? ?b\.? ?a\b\.?")
_PAREN = re.compile(r"\([^)]*\)")
_APOSTROPHE = re.compile(r"['’`´]")
_OTHER = re.compile(r"[^a-z0-9]+")


@lru_cache(1 << 16)
def name_parts(name: str | None) -> tuple[str, str, str, str, str]:
    """``core, kind, given, initials, acronym`` of an organization name.

    ``core`` is what tells it from others of its kind, ``kind`` the sorted type words, ``given``
    a formal given name or an initial standing for one, ``initials`` those of all words and
    ``acronym`` is set where the whole name is one.
    """
    text = plain(name).replace("&", " and ")
    text = _APOSTROPHE.sub("", _PAREN.sub(" ", text))
    aliases = [p for p in _DBA.split(text) if _OTHER.sub("", p)]
    text = aliases[-1] if aliases else ""
    raw = _OTHER.sub(" ", text).split()
    joined: list[str] = []
    for word in raw:
        if joined and joined[-1] == "play" and word in ("house", "hse"):
            joined[-1] = "playhouse"
        elif joined and joined[-1] in ("h", "m") and word == "s":
            joined[-1] += "s"
        elif joined and joined[-1] == "th" and word == "tre":
            joined[-1] = "theatre"
        elif joined and joined[-1] == "children" and word == "s":
            pass
        elif joined and joined[-1] == "el" and word in ("school", "sch", "pta", "p"):
            joined[-1:] = ["elementary", word]
        elif len(joined) > 1 and joined[-2:] == ["p", "t"] and word == "a":
            joined[-2:] = ["pta"]
        else:
            joined.append(word)
    while len(joined) > 1 and joined[-1] in ("inc", "incorporated", "llc", "ltd", "limited", "assn", "society", "foundation"):
        joined.pop()
    letters = "".join(w if len(w) == 0 else w[0] for w in " ".join(_token(w) for w in joined if w not in ("the", "of", "for", "at", "and", "le", "de")).split())
    if len(joined) >= 1 and all(w in NOISE for w in joined):
        words = joined
    else:
        words = [w for w in joined if w not in NOISE or (w in ("a", "d", "l") and len(joined) > 1)]
    rest = [w for w in words]
    acronym = rest[0] if len(rest) == 1 and 2 <= len(rest[0]) <= 6 and rest[0] not in EXPAND and rest[0] not in TYPES else ""
    tokens = " ".join(_token(w) for w in words).split()
    kinds = [t for t in tokens if t in TYPES]
    if "school" in kinds:
        kinds = [t for t in kinds if t not in ("drama", "club", "department")]
    if "elementary" in kinds:
        kinds = [t for t in kinds if t not in ("school", "drama", "club", "department")]
    if "opera" in kinds and "house" in kinds:
        kinds = [t for t in kinds if t not in ("arts", "council")]
    others = [t for t in tokens if t not in TYPES]
    given = next((t for t in others if t in GIVEN), "")
    if given:
        others.remove(given)
    singles = [t for t in others if len(t) == 1]
    longer = [t for t in others if len(t) > 1]
    if longer or given:
        others = longer
        if not given and singles:
            given = singles[0]
    return "".join(sorted(others)), " ".join(sorted(set(kinds))), given, letters, acronym


@lru_cache(1 << 16)
def locality(city: str | None) -> str:
    """A city name with its short forms written out, without spaces."""
    return "".join(PLACE.get(w, w) for w in _OTHER.sub(" ", _APOSTROPHE.sub("", plain(city))).split())


# Editions that make a show another show.
_EDITION = re.compile(r"\b(jr|junior|kids|youth|school|young|teen)\b")
_ARTICLE = re.compile(r"^(the|a|an) ")


@lru_cache(1 << 16)
def title_parts(title: str | None) -> tuple[str, str]:
    """``name, edition`` of a show title; ``edition`` is blank for the plain one."""
    text = _OTHER.sub(" ", _APOSTROPHE.sub("", plain(title).replace("&", " and "))).strip()
    marks = _EDITION.findall(text)
    edition = {"junior": "jr", "young": "youth"}.get(marks[-1], marks[-1]) if marks else ""
    text = re.sub(r"\b(edition|version)\b", " ", _EDITION.sub(" ", text))
    text = re.sub(r" the musical$", "", re.sub(r"\s+", " ", text).strip())
    return _ARTICLE.sub("", text).replace(" ", ""), edition


# Thoroughfares, directions and number words.
WAYS = {
    form: way
    for way, forms in {
        "street": "street st str", "avenue": "avenue ave av aven avn", "road": "road rd", "drive": "drive dr drv", "boulevard": "boulevard blvd boul bvd blv", "lane": "lane ln la", "court": "court ct crt", "place": "place pl plc",
        "highway": "highway hwy hiway", "terrace": "terrace ter terr", "parkway": "parkway pkwy pky pkway", "square": "square sq", "circle": "circle cir circ", "way": "way wy", "trail": "trail trl", "crescent": "crescent cres cr", "alley": "alley aly", "plaza": "plaza plz", "loop": "loop lp", "row": "row",
    }.items()
    for form in forms.split()
}
DIRECTIONS = {
    form: way
    for way, forms in {"n": "n north no", "s": "s south so", "e": "e east", "w": "w west", "ne": "ne northeast", "nw": "nw northwest", "se": "se southeast", "sw": "sw southwest"}.items()
    for form in forms.split()
}
ORDINALS = {w: str(i) for i, w in enumerate("zeroth first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth thirteenth fourteenth fifteenth sixteenth seventeenth eighteenth nineteenth twentieth".split())}
CARDINALS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split())}
_ROUTE = re.compile(r"\b(?:(county|co|cnty)\s+(?:road|rd|rte|route|hwy|highway)|(c r|cr)|(state|st)\s+(?:road|rd|route|rte|rt|hwy|highway)|(s r|sr|sh)|(us|u s|interstate|i)(?:\s+(?:hwy|highway|route|rte))?|(route|rte|rt|highway|hwy))\s+(\d+[a-z]?)\b")
_UNIT = re.compile(r"(?:#\s*|\b(?:suite|ste|unit|apt|apartment|room|rm|floor|fl|bldg|building)\b\.?\s*#?\s*)([a-z]?-?\d+[a-z]?|[a-z])\b\.?")
_POSTAL = re.compile(r"\b(\d{5})(?:-\d{4})?\b|\b([a-z]\d[a-z])\s?(\d[a-z]\d)\b")
_NUMBER = re.compile(r"(?:no|nr|number)\b\.?\s*(\d+[a-z]?|[a-z]+)(?:\s*(?:#|suite|ste|unit|apt|room|rm)\b.*|\s*#.*)?")
_BREAK = re.compile(r"<\s*/?\s*br\s*/?\s*>")


def _street(piece: str) -> tuple[str, str, str, str]:
    """``number, name, way, direction`` of one piece; blank name if it is no street."""
    words = _OTHER.sub(" ", _APOSTROPHE.sub("", piece)).strip()
    route = ""
    hit = _ROUTE.search(words)
    if hit:
        kind = next(k for k, g in zip(("county", "county", "route", "route", "us", "route"), hit.groups()) if g)
        route = f"{kind}{hit.group(7)}"
        words = words[: hit.start()] + " " + words[hit.end() :]
    tokens, number, ordinal = words.split(), "", ""
    if tokens and (re.fullmatch(r"\d+[a-z]?", tokens[0]) or (tokens[0] in CARDINALS and (len(tokens) > 1 or route))):
        number = CARDINALS.get(tokens[0], tokens[0])
        tokens = tokens[1:]
    elif tokens and (re.fullmatch(r"\d+[a-z]?", tokens[-1]) or (tokens[-1] in CARDINALS and len(tokens) > 1)):
        number, tokens = CARDINALS.get(tokens[-1], tokens[-1]), tokens[:-1]
        if tokens and tokens[-1] in ("no", "nr", "number"):
            tokens = tokens[:-1]
    way = direction = ""
    name: list[str] = []
    for i, word in enumerate(tokens):
        if word in DIRECTIONS and (len(tokens) > 1 or route) and (i in (0, len(tokens) - 1) or tokens[i + 1 : i + 2] == []) and (len(tokens) - i > 1 or name or route):
            direction = DIRECTIONS[word]
        elif word in WAYS and (name or route) and i >= len(tokens) - 2:
            way = WAYS[word]
        elif re.fullmatch(r"\d+(st|nd|rd|th)", word):
            name.append(re.sub(r"\D", "", word) + "th")
        elif word in ORDINALS:
            name.append(ORDINALS[word] + "th")
        else:
            name.append(word)
    if route:
        name = [route, *[]]
    return number, " ".join(name), way, direction


@lru_cache(1 << 15)
def address_parts(text: str | None) -> tuple[str, str, str, str, str, str, str, str, str]:
    """``form, number, name, way, direction, unit, postal, city, state`` of an address.

    Segments are parted by break tags and commas. ``form`` is ``street`` for a numbered street,
    ``cross`` for a crossing (``name`` holds both streets, sorted, parted by ``/``) and blank
    where neither is named. City and state are those of a trailing ``City, ST`` segment.
    """
    low = plain(text)
    segments = [s.strip(" .\t\r\n") for s in _BREAK.split(low)]
    city = state = postal = unit = ""
    pieces: list[str] = []
    for i, segment in enumerate(segments):
        hit = _POSTAL.fullmatch(segment)
        if hit:
            postal = postal or hit.group(1) or (hit.group(2) + hit.group(3))
            continue
        tail = re.fullmatch(r"(.*),\s*([a-z][a-z. ]+)", segment)
        if len(segments) > 1 and i > 0 and tail and not re.search(r"\d", segment) and "," not in tail.group(1) and not any(w in WAYS for w in tail.group(1).split()[-1:]):
            city, state = tail.group(1), tail.group(2).replace(".", "").strip()
            continue
        pieces += segment.split(",")
    found = ("", "", "", "", "")
    loose, apart = ("", "", "", ""), ""
    for piece in pieces:
        piece = piece.strip()
        if not piece:
            continue
        hit = _POSTAL.search(piece)
        if hit and re.fullmatch(r"[a-z. ]*", piece[: hit.start()] + piece[hit.end() :]) and hit.start() > 0:
            postal = postal or hit.group(1) or (hit.group(2) + hit.group(3))
            continue
        hit = _NUMBER.fullmatch(piece)
        if hit:
            apart = apart or CARDINALS.get(hit.group(1), hit.group(1))
            continue
        hit = _UNIT.search(piece)
        if hit and (piece[: hit.start()].strip() == "" or re.search(r"[a-z]", piece[: hit.start()])):
            unit, piece = unit or hit.group(1), (piece[: hit.start()] + " " + piece[hit.end() :]).strip()
        if not piece or found[0]:
            continue
        cross = re.fullmatch(r"(?:(?:at )?(?:the )?(?:corner|cnr|intersection|crossing)(?: of)? )?(.+?)\s*(?:&|/|@|\band\b|\bat\b)\s*(.+)", piece)
        if cross and not re.match(r"\d+\s", piece):
            a, b = _street(cross.group(1)), _street(cross.group(2))
            if a[1] and b[1] and (a[2] or b[2] or re.search(r"corner|intersection|cnr", piece)) and not a[0] and not b[0]:
                found = ("cross", "", "/".join(sorted((a[1], b[1]))), "", "")
                continue
        number, name, way, direction = _street(piece)
        if number and name and len(name) > 1:
            found = ("street", number, name, way, direction)
        elif name and not apart and (way or not loose[2]):
            loose = (number, name, way, direction)
    if not found[0] and loose[1] and apart:
        found = ("street", apart, *loose[1:])
    return (*found, unit, postal, city, state)


def best_assignment(worth: list[list[float]]) -> float:
    """Largest sum over one-to-one assignments of rows to columns; rows must not outnumber columns.

    Shortest augmenting paths with potentials: cubic in the number of components.
    """
    rows, columns = len(worth), len(worth[0])
    up, across = [0.0] * (rows + 1), [0.0] * (columns + 1)
    owner, way = [0] * (columns + 1), [0] * (columns + 1)
    for row in range(1, rows + 1):
        owner[0], at = row, 0
        least, used = [float("inf")] * (columns + 1), [False] * (columns + 1)
        while True:
            used[at] = True
            step, following = float("inf"), 0
            for c in range(1, columns + 1):
                if used[c]:
                    continue
                cost = -worth[owner[at] - 1][c - 1] - up[owner[at]] - across[c]
                if cost < least[c]:
                    least[c], way[c] = cost, at
                if least[c] < step:
                    step, following = least[c], c
            for c in range(columns + 1):
                if used[c]:
                    up[owner[c]] += step
                    across[c] -= step
                else:
                    least[c] -= step
            at = following
            if not owner[at]:
                break
        while at:
            owner[at] = owner[way[at]]
            at = way[at]
    return sum(worth[owner[c] - 1][c - 1] for c in range(1, columns + 1) if owner[c])


def assigned(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Share of letters matched by the best one-to-one assignment of components, 0 to 1.

    A pair of components counts if it is within one edit (two, a slip on each side, from six letters on); components
    under four letters or with digits must be equal.
    """
    if not a or not b:
        return 0.0
    short, long = sorted((a, b), key=len)

    def worth(x: str, y: str) -> float:
        if x == y:
            return len(x)
        least = min(len(x), len(y))
        most = 0 if least < 4 or re.search(r"\d", x + y) else 1 if least < 6 else 2
        d = edits(x, y, most) if most else most + 1
        return max(len(x), len(y)) - d if d <= most else 0.0

    return best_assignment([[worth(x, y) for y in long] for x in short]) / max(sum(map(len, a)), sum(map(len, b)))
