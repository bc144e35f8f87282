"""Round-trip repair of text that was decoded with the wrong character encoding.

A garbled stretch is re-encoded under a candidate legacy encoding and strictly
decoded as what it was meant to be; the result is accepted when the garbling
cost drops. This is repeated for nested layers. Two families are tried:

* UTF-8 bytes read as a single-byte encoding. Such stretches are sequences of a
  lead byte and its continuation bytes, so they are found and repaired in place,
  also where only a part of the text is garbled. Two continuation bytes in step
  with their leads are no accident, so any script is restored; a single
  two-byte sequence must give a letter or sign of European text;
* one single-byte encoding read as another (Cyrillic and Latin alphabets). Such
  words are judged by their cost: letters and symbols mixed in a word, capitals
  after small letters, several scripts in a word, control characters; and Latin
  letters that the language of the text's other words does not have.

The replacement character U+FFFD shows that bytes were lost: the record is
affected, the rest of it is repaired.

Defined results: null and empty texts are not affected; a text without
characters beyond ASCII never is; repeated rows are judged alike.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundloom.functions.frames import frame

#: Encodings as which UTF-8 bytes may have been read, the commonest first.
MISREAD_UTF8 = ("cp1252", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "koi8_r", "cp866", "iso8859_2", "cp1254", "cp1257", "cp1253")
#: Of these, those as which other scripts may have been read: the others share letters with Cyrillic and Greek text.
OTHER_UTF8 = ("cp1252", "mac_roman")
#: (read as, meant as) for single-byte text.
MISREAD_SINGLE = (
    ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp1252", "cp1251"), ("cp1252", "koi8_r"), ("cp1251", "cp866"), ("cp866", "cp1251"),
    ("cp437", "cp866"), ("cp1252", "cp1250"), ("cp1250", "cp1252"), ("cp1252", "iso8859_2"), ("cp437", "cp1252"), ("cp850", "cp1252"),
    ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp1251", "cp1252"), ("cp1251", "cp1250"),
    ("cp1252", "cp866"), ("cp1252", "iso8859_5"), ("cp1251", "iso8859_5"),
)
#: (read as, meant as) for Latin text whose garbled letters are still letters; judged by the language of the text.
MISREAD_LATIN = (("cp1250", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp1250"), ("iso8859_2", "cp1252"), ("cp1252", "iso8859_2"), ("cp850", "cp1252"), ("cp1257", "cp1252"), ("cp1252", "cp1257"))
#: Languages of the Latin alphabet with their letters beyond ASCII and common words in plain letters.
LANGUAGES = {
    "french": ("àâæçéèêëîïôœùûüÿ", "le la les des du de et un une est dans pour que qui sur par au aux en"), "german": ("äöüß", "der die das und den dem des ist im von mit zu auf ein eine nicht"),
    "spanish": ("áéíñóúü", "el la los las de del y un una en que por con para se al"), "portuguese": ("àáâãçéêíóôõúü", "o a os as de do da dos das e um uma em que por com para no na"),
    "italian": ("àéèìíîòóùú", "il lo la gli le di del della e un una in che per con si al"), "dutch": ("áéèëïóöü", "de het een en van in is op te dat met voor zijn"),
    "danish": ("æøåé", "og den det en et af til i er som for med ikke"), "swedish": ("åäöé", "och den det en ett av till i som med inte att"),
    "polish": ("ąćęłńóśźż", "w na z do nie o po jest oraz od dla przez za przy"), "czech": ("áčďéěíňóřšťúůýž", "a v na se z do je o pro od po s byl jako"),
    "hungarian": ("áéíóöőúüű", "a az egy nem hogy van meg is volt ezt"), "romanian": ("ăâîșşțţ", "de la cu pe un o din care nu este pentru"),
    "turkish": ("âçğıîöşü", "ve bir bu ile da de olarak daha ne var"), "croatian": ("čćđšž", "i u na je se za od da su s kao"),
}
LOST = "�"


@functools.cache
def _characters(encoding: str) -> dict[int, str]:
    """Character of each byte that the encoding defines."""
    out = {}
    for b in range(256):
        try:
            out[b] = bytes([b]).decode(encoding)
        except UnicodeDecodeError:
            pass
    return out


@functools.cache
def _to_bytes(encoding: str) -> dict[str, int]:
    """Byte of each character. A control character stands for the byte of its number where that byte may be undefined."""
    out = {c: b for b, c in _characters(encoding).items()}
    if encoding.startswith("cp125"):
        out |= {chr(b): b for b in range(128, 160) if chr(b) not in out}
    return out


@functools.cache
def _sequences() -> tuple[re.Pattern, re.Pattern]:
    """One multi-byte UTF-8 sequence, and a row of them, as they look when read as cp1252 or as Latin-1."""
    by = _characters("cp1252")
    chars = lambda lo, hi: "".join(re.escape(c) for b in range(lo, hi + 1) for c in sorted({by.get(b, chr(b)), chr(b)}))
    cont = f"[{chars(0x80, 0xBF)}]"
    one = "|".join(f"[{chars(lo, hi)}]{cont}{{{n}}}" for lo, hi, n in ((0xC2, 0xDF, 1), (0xE0, 0xEF, 2), (0xF0, 0xF4, 3)))
    return re.compile(one), re.compile(f"(?:{one})+")


@functools.cache
def _leads(encoding: str) -> frozenset[str]:
    by = _characters(encoding)
    return frozenset(by[b] for b in range(0xC2, 0xF5) if b in by)


def _plausible(c: str) -> bool:
    """Letters and signs of running text in the scripts of this corpus."""
    o = ord(c)
    return (
        0xA0 <= o <= 0x17F or o in (0x192, 0x218, 0x219, 0x21A, 0x21B, 0x2C6, 0x2DC) or 0x386 <= o <= 0x3CE or 0x400 <= o <= 0x45F
        or 0x2010 <= o <= 0x203A or 0x20A0 <= o <= 0x20BF or 0x2070 <= o <= 0x209F or 0x2100 <= o <= 0x23FF or 0x2500 <= o <= 0x25FF or o in (0xFB01, 0xFB02)
    )


def _assigned(c: str) -> bool:
    """Whether a character is in use at all: assigned, not private, no control."""
    return unicodedata.category(c) not in ("Cn", "Co", "Cs", "Cc")


def _unmisread(garbled: str, encoding: str, other: bool = False) -> str:
    """What the bytes of ``garbled`` were meant as, or ``garbled``; characters of other scripts only where ``other``."""
    table = _to_bytes(encoding)
    try:
        meant = bytes(table[c] if c in table else ord(c) for c in garbled).decode("utf-8")
    except (UnicodeDecodeError, ValueError):
        return garbled
    # nested layers leave controls that the next round resolves
    odd = [c for c in meant if not (_plausible(c) or 0x80 <= ord(c) < 0xA0)]
    if all(ord(c) > 0xFFFF and unicodedata.category(c) == "So" for c in odd):  # four bytes in step
        return meant
    return meant if other and all(map(_assigned, odd)) else garbled


_RUN = re.compile(r"[^\x00-\x7f]{2,}")


def _other_scripts(text: str) -> bool:
    """Whether the text holds UTF-8 of other scripts that was misread.

    Bytes of some single-byte alphabets fall into step by chance, so of the
    runs that European letters don't explain nearly all must decode whole.
    """
    good = bad = 0
    for m in _RUN.finditer(text):
        kind = _other_kind(m.group())
        good += max(0, kind)
        bad += max(0, -kind)
    return good >= 3 and good >= 4 * bad


@functools.lru_cache(maxsize=200_000)
def _other_kind(run: str) -> int:
    """The length of a run that is UTF-8 of another script misread, minus that of one that looks so but is not; 0 for others."""
    if any(run[0] in _leads(e) and all(c in _to_bytes(e) for c in run) and _unmisread(run, e) != run for e in MISREAD_UTF8):
        return 0
    forms = [x for x in (run, run.strip(_EDGES)) if len(x) > 1]
    if any(_unmisread(x, e, True) != x for x in forms for e in OTHER_UTF8 if x[0] in _leads(e) and all(c in _to_bytes(e) or ord(c) < 0xA0 for c in x)):
        return len(run)
    return -len(run) if run[0] in _leads("cp1252") or any(0x80 <= ord(c) < 0xA0 for c in run) else 0


@functools.lru_cache(maxsize=200_000)
def _fix_run(run: str, other: bool = False) -> str:
    """A run of characters beyond ASCII with one layer undone.

    A run that decodes as a whole is taken whole, under the first encoding that
    explains it; else sequences of cp1252 are repaired wherever they stand in
    it. Several of the other encodings share letters with real text, so parts
    of a run are no evidence for them.
    """
    for encoding in MISREAD_UTF8:
        if run[0] in _leads(encoding) and all(c in _to_bytes(encoding) for c in run):
            new = _unmisread(run, encoding, other and encoding in OTHER_UTF8)
            if new != run:
                return new
    one, several = _sequences()
    whole = several.sub(lambda m: _unmisread(m.group(), "cp1252", other), run)
    return whole if whole != run else one.sub(lambda m: _unmisread(m.group(), "cp1252"), run)


#: Runs of letters and of characters beyond ASCII, whatever these are: a garbled letter may be a sign or a hard blank.
_WORD = re.compile("[A-Za-z]*[\x80-\U0010ffff][A-Za-z\x80-\U0010ffff]*")
#: Signs that people do write between letters.
_JOINERS = set("’‘'–—‐‑·™®©°") | {"\u00ad"}
_EDGES = "“”„«»‹›’‘–—…•€£¥¢§±÷→≤≈Δσπ√│†‡\u00a0"


def _script(c: str) -> int:
    o = ord(c)
    return 1 if o < 0x250 else 2 if 0x400 <= o < 0x530 else 3 if 0x370 <= o < 0x400 else 0


@functools.lru_cache(maxsize=200_000)
def word_cost(word: str) -> float:
    """Garbling cost of a run of characters: 0 for a word as people write it."""
    cost = 3.0 * sum(0x80 <= ord(c) < 0xA0 for c in word)
    core = word.strip(_EDGES)
    if not core:
        return cost + 2.0 * (len(word) > 2)
    letters = [c for c in core if c.isalpha() and c not in "ªº"]
    cost += 2.0 * max(0, len({_script(c) for c in letters} - {0}) - 1)
    if letters and all(_script(c) == 2 for c in letters):
        cost += 2.0 * (core[0].islower() and any(c.isupper() for c in core[1:]))
        cost += 1.0 * (core[0] in "ЪЬЫъьы") + 1.5 * (len(core) > 3 and not any(c in "аеёиоуыэюяАЕЁИОУЫЭЮЯ" for c in core))
    high = sum(ord(c) > 127 for c in letters)
    cost += 2.0 * (len(core) >= 3 and high >= 0.7 * len(core) and all(_script(c) == 1 for c in letters) and not core.isupper())
    signs = [i for i, c in enumerate(core) if ord(c) > 127 and (not c.isalpha() or c in "ªº") and c not in _JOINERS]
    cost += sum(2.0 if 0 < i < len(core) - 1 else 1.0 if len(core) >= 4 else 0.0 for i in signs)
    return cost


def _swap_single(text: str) -> tuple[str, int]:
    """The stretch whose words' cost drops most under one pair of single-byte encodings, swapped.

    The pair must explain at least three different words, or one that no one
    writes so, and half of the cost.
    """
    words = list(_WORD.finditer(text))
    costs = [word_cost(m.group()) for m in words]
    total = sum(costs)
    if total < 3:
        return text, 0
    best: tuple[float, list] = (0.0, [])
    for read, meant in MISREAD_SINGLE:
        table, gain, spans, distinct = _to_bytes(read), 0.0, [], set()
        for m, cost in zip(words, costs, strict=True):
            w = m.group()
            try:
                new = bytes(table[c] for c in w).decode(meant)
            except (KeyError, UnicodeDecodeError):
                continue
            after = word_cost(new)
            core = new.strip(_EDGES)
            if not core.isalpha() or after > cost:
                continue
            spans.append((m.start(), m.end(), new, cost - after))
            gain += cost - after
            if cost > after:
                distinct.add(w)
        if gain > best[0] and (len(distinct) >= 3 or any(span[3] >= 3 for span in spans)):
            best = (gain, spans)
    if best[0] < 0.5 * total:
        return text, 0
    gained = [k for k, span in enumerate(best[1]) if span[3] > 0]
    out, at = [], 0
    for a, b, new, _ in best[1][gained[0]: gained[-1] + 1]:
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:], len(gained)


_LETTERS = re.compile(r"[^\W\d_]+")


@functools.cache
def _common() -> dict[str, tuple[str, ...]]:
    """The languages of each common word."""
    out: dict[str, list[str]] = {}
    for name, (_, words) in LANGUAGES.items():
        for w in words.split():
            out.setdefault(w, []).append(name)
    return {w: tuple(names) for w, names in out.items()}


def _languages(text: str) -> list[str]:
    """The languages of most words, ties included: common words vote, and by half those spelled with its letters; none for fewer than a tenth."""
    words, votes, common = Counter(text.lower().split()), {}, _common()
    for w in words.keys() & common.keys():
        for name in common[w]:
            votes[name] = votes.get(name, 0) + float(words[w])
    for w in (w for w in words if not w.isascii()):
        high = {c for c in w if ord(c) > 127 and c.isalpha()}
        for name, (letters, _) in LANGUAGES.items():
            if high and high <= set(letters):
                votes[name] = votes.get(name, 0) + 0.5 * words[w]
    best = max(votes.values(), default=0.0)
    return sorted(n for n, v in votes.items() if v == best) if best >= max(2, 0.1 * words.total()) else []


def _inner_capital(word: str) -> bool:
    """Whether a capital beyond ASCII follows a small letter."""
    return any(ord(b) > 127 and b.isupper() and a.islower() for a, b in zip(word, word[1:], strict=False))


def _swap_latin(text: str) -> tuple[str, int]:
    """The text swapped under the pair that leaves the fewest words with letters foreign to its language.

    A pair must clear the words it changes - most of them foreign before, none
    but a few after -, at least two, or one with a capital inside; so a name
    from elsewhere stays.
    """
    high = " ".join({w for w in text.split() if not w.isascii()})
    words = {w for w in _LETTERS.findall(high) if not w.isascii() and all(_script(c) == 1 for c in w)}
    for language in _languages(text) if words else []:
        done = _swap_to(text, words, set(LANGUAGES[language][0]))
        if done[1]:
            return done
    return text, 0


def _swap_to(text: str, words: set[str], own: set[str]) -> tuple[str, int]:
    foreign = lambda w: _inner_capital(w) or any(ord(c) > 127 and c not in own for c in w.lower())
    if not any(map(foreign, words)):
        return text, 0
    for read, meant in MISREAD_LATIN:
        table = _to_bytes(read)

        def swapped(w: str) -> str | None:
            try:
                return bytes(table[c] for c in w).decode(meant)  # noqa: B023
            except (KeyError, UnicodeDecodeError):
                return None

        changed = {w: n for w in words if (n := swapped(w)) is not None and n != w}
        wrong = sum(not all(c.isalpha() or c in _JOINERS for c in n) or foreign(n) for n in changed.values())
        if not changed or wrong > 0.05 * len(changed) or sum(map(foreign, changed)) < 0.6 * len(changed):
            continue
        if len(changed) < 2 and not any(map(_inner_capital, changed)):
            continue
        hits = 0

        def fix(m: re.Match) -> str:
            nonlocal hits
            w = m.group()
            n = changed.get(w, w)  # noqa: B023
            if n == w and w not in words and not w.isascii() and re.search("[A-Za-z]", w) and (new := swapped(w)) and all(c.isalpha() or c in _JOINERS for c in new) and not foreign(new):  # noqa: B023
                n = new  # a letter garbled to a sign inside a word
            hits += n != w
            return n

        return _WORD.sub(fix, text), hits
    return text, 0


def repair(text: str | None) -> tuple[str | None, int, bool]:
    """(repaired text, number of garbled stretches, whether bytes were lost)."""
    if not text or text.isascii():
        return text, 0, False
    stretches, lost = text.count(LOST), LOST in text
    text, hits = _layers(text)
    text, swapped = _swap_single(text)
    if not swapped:
        text, swapped = _swap_latin(text)
    text, more = _layers(text)
    return text, stretches + hits + swapped + more, lost


def _layers(text: str) -> tuple[str, int]:
    """The text with UTF-8 that was misread repaired layer by layer; the number of runs repaired."""
    hits = 0

    def fix(m: re.Match) -> str:
        nonlocal hits
        new = _fix_run(m.group(), other)
        hits += new != m.group()
        return new

    before = None
    while text != before:  # each layer undone makes the text shorter
        other = _other_scripts(text)
        before, text = text, _RUN.sub(fix, text)
    return text, hits


#: A Java pattern that every affected text matches: a character beyond ASCII that is not a common sign of English text.
SUSPECT = r"[^\x00-\x{7f}€£’“”–…—]|[€£’“”–…—]{2}"


def repaired(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, repaired_text, stretches, lost_bytes, recovered) of the affected rows of ``df``.

    A JVM-side pattern keeps texts that can't be affected out of Python; there
    is no shuffle.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            done = [repair(t) for t in f["t"]]
            hit = [i for i, d in enumerate(done) if d[1]]
            yield frame(k=f["k"].iloc[hit], repaired_text=[done[i][0] for i in hit], stretches=[done[i][1] for i in hit], lost_bytes=[done[i][2] for i in hit])

    found = df.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.col("t").rlike(SUSPECT)).mapInPandas(
        run, f"k {kind}, repaired_text string, stretches int, lost_bytes boolean"
    )
    return found.select(F.col("k").alias(key), "repaired_text", "stretches", "lost_bytes", (~F.col("lost_bytes")).alias("recovered"))
