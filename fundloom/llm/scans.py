"""Noise in text from scanned pages: found, and repaired into continuous paragraphs.

Three stages, each distributed over the blocks:

1. Page furniture. A file's running heads are the lines in title case or capitals
   that recur in its blocks; the number a page should carry follows from the
   file's own labels (the commonest offset between physical and printed pages,
   roman before it). Lines that hold head or number are taken out.
2. Words divided by line ends are joined where the joined word is written
   undivided elsewhere in the corpus; a compound that is written with its own
   hyphen keeps it.
3. Misread characters. Every distinct word runs through the Levenshtein
   automaton of degree one with merges and splits (two characters read as one
   and the reverse), intersected with tries of the vocabulary: this retrieves
   all words one misreading away. All of them are carried to the places where
   the word stands and ranked there by the neighbouring words, by frequency and
   by whether the confusion is a usual one.

The vocabulary is counted over the whole corpus. Its words are filed under their
length and first half and under their length and last half: one misreading
leaves one of the halves intact, so a word visits six files, and each file is a
trie in one task. Places and word pairs are sought by a bitmap of fixed size
over hashes in one scan, so only places of suspicious words are shuffled.

Defined results: null and empty texts carry no noise of their own; a block
without a file stands in a file of that name ''; repeated rows give one result;
a file without numbered labels has no expected numbers, so bare numbers stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundloom.functions.frames import frame
from fundloom.operators.skew import hot_keys, join_unique
from fundloom.session import spread, written

# How characters are commonly misread, as (read, true).
CONFUSIONS = {
    ("c", "e"), ("e", "c"), ("!", "i"), ("ri", "n"), ("n", "ri"), ("f", "t"), ("t", "f"), ("cl", "d"), ("d", "cl"), ("0", "o"), ("5", "s"), ("1", "l"), ("1", "i"),
    ("ii", "u"), ("u", "ii"), ("rn", "m"), ("m", "rn"), ("m", "in"), ("in", "m"), ("9", "g"), ("b", "h"), ("h", "b"), ("vv", "w"), ("w", "vv"), ("li", "h"), ("h", "li"),
    ("8", "B"), ("6", "b"), ("2", "z"), ("0", "O"), ("5", "S"), ("1", "I"), ("|", "l"), ("|", "I"), ("l", "I"), ("I", "l"), ("q", "g"), ("y", "v"), ("h", "ti"), ("ti", "h"),
}
#: Letters read for digits.
DIGIT_FOR = str.maketrans("OoIlBSZ|!", "001185211")
ROMAN = r"(?=[ivxlc])(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
PAGE_FORMS = [rf"^page (\d+|{ROMAN})$", rf"^page (\d+|{ROMAN}) of \d+$", rf"^p\. ?(\d+|{ROMAN})$", rf"^[-–] ?(\d+|{ROMAN}) ?[-–]$", rf"^\[(\d+|{ROMAN})\]$"]
WITH_HEAD = rf"^(?:(\d+|{ROMAN})   +(.+)|(.+?) +\| (\d+|{ROMAN}))$"
NUMBER = r"(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?"
BREAK = "[-­‐]"
#: A word is a usual misreading of another that is at least so many times as frequent, and an unusual one of one so many times.
RATIO, FAR_RATIO = 5, 50
#: A line is a running head if it stands in at least so many blocks of its file, and in such a part of them.
HEAD_BLOCKS, HEAD_SHARE = 3, 0.01
#: Bits of the bitmaps by which places are sought: 2 MB each, whatever the corpus.
BITS = 1 << 24
#: Stands in a word where a line end divided it.
JOINED = "\x01"


def clean_label(label: str | None) -> str | None:
    """The plain number or lower-case roman numeral of a printed page label."""
    if label is None:
        return None
    s = re.sub(r"^\W*(?:page|p\.)?\s*|\W+$", "", label.strip().lower()) if not re.search(r"[|]", label) else label.strip()
    s = re.sub(r"\s+of\s+\d+$", "", s)
    if re.fullmatch(ROMAN, s):
        return s
    digits = label.strip().translate(DIGIT_FOR) if re.fullmatch(r"[\dOoIlBSZQ|!]+", label.strip()) else s
    digits = digits.replace("Q", "0").replace("q", "0")
    return digits if digits.isdigit() else s or None


def roman(n: int) -> str:
    out = ""
    for value, sign in ((90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        out += sign * (n // value)
        n %= value
    return out


def furniture(text: str, expected: str | None, own: str | None, heads: set[str]) -> tuple[set[str], str]:
    """(kinds, text without them) of one block."""
    kinds, kept = set(), []
    numbers = {x for x in (expected, own) if x}
    for line in text.split("\n"):
        s = re.sub(r"\s+$", "", line.strip().lower())
        combined = re.match(WITH_HEAD, s)
        if combined and (combined.group(2) or combined.group(3)) in heads:
            kinds |= {"header", "page_number"}
        elif s in heads:
            kinds.add("header")
        elif (page := next((m.group(1) for m in (re.match(p, s) for p in PAGE_FORMS) if m), None)) and (not numbers or page in numbers or s.startswith("p")):
            kinds.add("page_number")
        elif s in numbers and s:
            kinds.add("page_number")
        else:
            kept.append(line.rstrip())
    return kinds, "\n".join(kept)


def number_misread(word: str) -> bool:
    """Whether a number holds letters in place of digits."""
    m = re.fullmatch(r"([$€£]?)([\dOoIlBS|.,]+)(x|%|th|mn|m|k|bn)?", word)
    if not m or not re.search(r"\d", m.group(2)) or not re.search(r"[OoIlBS|]", m.group(2)):
        return False
    if re.fullmatch(NUMBER + "[BS]", m.group(2)):  # billions, or several
        return False
    return re.fullmatch(NUMBER, m.group(2).translate(DIGIT_FOR)) is not None and (len(m.group(2)) > 2 or word[0] not in "BS")


# ------------------------------------------------- Levenshtein automaton and trie


def build_trie(words: list[str]) -> dict:
    root: dict = {}
    for w in words:
        _add(root, w)
    return root


def _add(root: dict, word: str) -> None:
    node = root
    for c in word:
        node = node.setdefault(c, {})
    node[""] = word


def near(word: str, trie: dict) -> list[str]:
    """Every word of the trie within one edit, merge or split of ``word``: the automaton of degree one run along the trie.

    Before the error the automaton has one state and follows one path of the
    trie; at each of its nodes it branches into the errors - one character
    replaced, dropped or added, two of the word read as one of the trie (merge)
    or one as two (split) - and behind each there is again one path.
    """
    n, found, node = len(word), set(), trie

    def rest(node: dict, i: int) -> None:
        while node is not None and i < n:
            node, i = node.get(word[i]), i + 1
        if node is not None and "" in node:
            found.add(node[""])

    for i in range(n + 1):
        if i < n:
            rest(node, i + 1)  # one character too many
        for c, child in node.items():
            if not c:
                continue
            rest(child, i)  # one missing
            if i < n:
                rest(child, i + 1)  # one replaced
                if i + 1 < n:
                    rest(child, i + 2)  # two for one
                for d, grandchild in child.items():
                    if d:
                        rest(grandchild, i + 1)  # one for two
        if i == n or (node := node.get(word[i])) is None:
            break
    found.discard(word)
    return sorted(found)


def _half(length: int) -> int:
    """Characters of a half: of a word of that length, one misreading leaves so many at the start or at the end intact."""
    return max(0, (length - 2) // 2)


def files_of(word: str) -> list[str]:
    """The files that hold a word of the vocabulary."""
    h = _half(len(word))
    return [f"{len(word)}<{word[:h]}", f"{len(word)}>{word[len(word) - h:]}"]


def files_near(word: str) -> list[str]:
    """The files of which one holds each word that ``word`` may be a misreading of."""
    out = []
    for length in range(max(1, len(word) - 1), len(word) + 2):
        h = _half(length)
        if h <= len(word):
            out += [f"{length}<{word[:h]}", f"{length}>{word[len(word) - h:]}"]
    return out


def confusion(read: str, true: str) -> tuple[str, str] | None:
    """The known confusion that turns ``true`` into ``read``, if one does."""
    a = 0
    while a < min(len(read), len(true)) and read[a] == true[a]:
        a += 1
    for start in range(max(0, a - 1), a + 1):
        for r, t in CONFUSIONS:
            if read.startswith(r, start) and true.startswith(t, start) and read[start + len(r):] == true[start + len(t):]:
                return r, t
    return None


# ------------------------------------------------------------------ distributed


def _file_facts(blocks: DataFrame) -> DataFrame:
    """(file_id, offset, heads): one row per file."""
    label = F.regexp_extract("printed_page", r"^(\d+)$", 1).try_cast("int")
    offsets = blocks.filter(label.isNotNull() & F.col("physical_page").isNotNull()).groupBy("file_id", (F.col("physical_page") - label).alias("offset")).agg(
        F.count(F.lit(1)).alias("n")
    ).groupBy("file_id").agg(F.max_by("offset", F.struct("n", -F.col("offset"))).alias("offset"))
    # recurring title lines of at least three words, without the number that may stand in the line; every word but small ones starts with a capital
    title = r"^(?:(?:to|the|of|and|for|in|on|–|-|[^\sa-z]\S*|\([a-z]+\))(?: +|$)){3,}$"
    number = r"^(?:\d+|[ivxlc]+)   +| +\| (?:\d+|[ivxlc]+)$"
    bare = lambda x: F.struct(F.regexp_replace(F.trim(x), number, "").alias("line"), F.trim(x).rlike(number).alias("numbered"))
    heading = lambda x: x.rlike(title) & ~x.rlike(r"[.,;:]$") & x.rlike(r"\p{Lu}\S+ .*\p{Lu}\S+ .*\p{Lu}")
    kept = F.filter(F.transform(F.split("original_text", "\n"), bare), lambda x: heading(x["line"]))
    lines = blocks.select("file_id", F.explode(F.array_distinct(F.transform(kept, lambda x: F.struct(F.lower(x["line"]).alias("line"), x["numbered"].alias("numbered"))))).alias("x"))
    sizes = blocks.groupBy("file_id").agg(F.count(F.lit(1)).alias("blocks"))
    often = lines.groupBy("file_id", "x.line").agg(F.count(F.lit(1)).alias("n"), F.max("x.numbered").alias("numbered")).filter(
        (F.col("n") >= HEAD_BLOCKS) | (F.col("numbered") & (F.col("n") >= 2))  # a line that also carries the page's number needs less evidence
    )
    # a line in a hundredth of a file's blocks: each block adds its own lines once, so a file has few of them
    heads = often.join(sizes, "file_id").filter(F.col("n") >= HEAD_SHARE * F.col("blocks")).groupBy("file_id").agg(F.sort_array(F.collect_list("line")).alias("heads"))
    return offsets.join(heads, "file_id", "full_outer")


def prepared(blocks: DataFrame) -> DataFrame:
    """(block_id, kinds, body, words): the furniture found in each block, its text without it and the words of that."""
    b = blocks.select(
        "block_id", F.coalesce("file_id", F.lit("")).alias("file_id"), "physical_page", "printed_page",
        F.coalesce("original_text", "search_text", F.lit("")).alias("original_text"),
    ).dropDuplicates(["block_id"])
    joined = join_unique(b, _file_facts(b), ["file_id"], "left", hot_keys(b, ["file_id"]))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            kinds, bodies = [], []
            for text, label, page, offset, heads in zip(f["original_text"], f["printed_page"], f["physical_page"], f["offset"], f["heads"], strict=True):
                expected = None
                if not pd.isna(offset) and not pd.isna(page):
                    n = int(page) - int(offset)
                    expected = str(n) if n > 0 else roman(int(page))
                label = None if label is None or label is pd.NA or label != label else label
                found, body = furniture(text, expected, clean_label(label), set() if heads is None else set(heads))
                if label is not None and not re.fullmatch(rf"\d+|{ROMAN}", label):
                    found.add("page_label")
                kinds.append(sorted(found))
                bodies.append(body)
            yield frame(block_id=f["block_id"], kinds=kinds, body=bodies)

    bare = joined.mapInPandas(run, "block_id string, kinds array<string>, body string")
    whole = F.regexp_replace("body", rf"(?<=[A-Za-z!]){BREAK}\n(?=[A-Za-z!])", JOINED)
    return written(bare.withColumn("words", _words(whole)))


WORD_ENDS = r"^[\"“”‘’'()\[\],;:.–—?]+|[\"“”‘’'()\[\],;:.–—?]+$"


def _words(text):
    """Words of a text as an array, punctuation around them dropped."""
    return F.filter(F.transform(F.split(F.trim(text), r"\s+"), lambda w: F.regexp_replace(w, WORD_ENDS, "")), lambda w: w != "")


def divided(prep: DataFrame) -> DataFrame:
    """(block_id, left, right) of each word divided by a line end."""
    pattern = rf"([A-Za-z][A-Za-z'’!0-9-]*){JOINED}([A-Za-z!0-9]+)"
    cut = prep.select("block_id", F.explode(F.filter("words", lambda w: w.contains(JOINED))).alias("w"))
    return cut.select("block_id", F.regexp_extract("w", pattern, 1).alias("left"), F.regexp_extract("w", pattern, 2).alias("right")).filter("left != ''")


def vocabulary(prep: DataFrame) -> DataFrame:
    """(word, n) over all blocks, of words that stand undivided."""
    return prep.select(F.explode("words").alias("word")).filter(~F.col("word").contains(JOINED)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def readings(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """(word, n, true_word, n_true, usual): every word of the vocabulary one misreading from each distinct word and frequent enough.

    ``words`` has (word, n). A word of the vocabulary must be ``RATIO`` times as
    frequent, so words seen less often than that can't be the true ones of any.
    """
    letters = r"^[\p{L}!0-9|][\p{L}\d!|'’&-]*$"
    known = vocab.filter(F.col("word").rlike(r"^[\p{L}][\p{L}'’&-]+$") & (F.col("n") >= RATIO))
    odd = words.filter(F.col("word").rlike(letters) & F.col("word").rlike(r"[\p{L}].*[\p{L}]|[\p{L}]{2}"))
    filed = F.pandas_udf(lambda w: w.map(files_of), "array<string>")
    visits = F.pandas_udf(lambda w: w.map(files_near), "array<string>")
    both = known.select(F.explode(filed("word")).alias("file"), F.lit(0).alias("asks"), "word", "n").unionByName(
        odd.select(F.explode(visits("word")).alias("file"), F.lit(1).alias("asks"), "word", "n")
    )
    out = ("word", "n", "true_word", "n_true", "usual")

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Files come sorted, in each the vocabulary first: one trie at a time."""
        at, counts, trie = None, {}, {}
        for f in frames:
            rows = []
            for file, asks, w, n in zip(f["file"], f["asks"], f["word"], f["n"], strict=True):
                if file != at:
                    at, counts, trie = file, {}, {}
                if not asks:
                    counts[w] = int(n)
                    _add(trie, w)
                elif counts:
                    for c in near(w, trie):
                        if c.replace("-", "") == w.replace("-", ""):
                            continue  # another way to write it
                        usual = confusion(w, c) is not None
                        if counts[c] >= (RATIO if usual else FAR_RATIO) * n:
                            rows.append((w, int(n), c, counts[c], usual))
            yield frame(**{k: [r[i] for r in rows] for i, k in enumerate(out)})

    laid = spread(both, "file").sortWithinPartitions("file", "asks")
    return laid.mapInPandas(look, "word string, n bigint, true_word string, n_true bigint, usual boolean").distinct()


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bits of a column ``h`` of hashes: :data:`BITS` of them, so the driver gets 2 MB at most."""
    at = F.pmod("h", F.lit(BITS))
    parts = hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).collect()
    bits = np.zeros(BITS // 8 + 4096, dtype=np.uint8)
    for r in parts:
        start = r["b"] * 4096
        bits[start: start + 4096] = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
    return bits


def _pair_hash(a: Column, b: Column) -> Column:
    return F.xxhash64(a).bitwiseXOR(F.shiftleft(F.xxhash64(b), 1))


def _hashed(prep: DataFrame) -> DataFrame:
    plain = F.transform("words", lambda w: F.replace(w, F.lit(JOINED), F.lit("")))
    return prep.select("block_id", plain.alias("w")).withColumn("h", F.transform("w", lambda w: F.xxhash64(w)))


def _test(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = np.mod(h, BITS)
    # bit v stands at bucket ceil(v / 32768) - the first also holds 0 - and position (v - 1) mod 32768
    bucket = np.where(at > 0, (at - 1) // 32768 + 1, 0)
    position = np.where(at > 0, (at - 1) % 32768, 0)
    byte = bucket * 4096 + position // 8
    return (bits[byte] >> (position % 8).astype(np.uint8)) & 1 > 0


def places(prep: DataFrame, words: DataFrame) -> DataFrame:
    """(block_id, previous, word, following) wherever one of the distinct ``words`` stands."""
    sought = _bitmap(words.select(F.xxhash64("word").alias("h")))
    bits = prep.sparkSession.sparkContext.broadcast(sought)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, h, offsets = _flat(b)
            hit = np.flatnonzero(_test(bits.value, h))
            row = np.searchsorted(offsets, hit, "right") - 1
            before = np.where(hit > offsets[row], hit - 1, -1)
            after = np.where(hit + 1 < offsets[row + 1], hit + 1, -1)
            take = lambda i: flat.take(pa.array(np.maximum(i, 0), mask=i < 0))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), take(before), take(hit), take(after)], ["block_id", "previous", "word", "following"])

    return _hashed(prep).mapInArrow(run, "block_id string, previous string, word string, following string").join(words.select("word"), "word", "left_semi")


def pair_counts(prep: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, k): how often each of the distinct ``pairs`` (a, b) of neighbouring words stands in the blocks."""
    bits = prep.sparkSession.sparkContext.broadcast(_bitmap(pairs.select(_pair_hash(F.col("a"), F.col("b")).alias("h"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat, h, offsets = _flat(b)
            same = np.ones(max(0, len(h) - 1), bool)
            inner = offsets[1:-1]
            same[inner[(inner > 0) & (inner < len(h))] - 1] = False
            hit = np.flatnonzero(_test(bits.value, h[:-1] ^ (h[1:] << 1)) & same) if len(h) > 1 else np.array([], int)
            yield pa.RecordBatch.from_arrays([flat.take(pa.array(hit)), flat.take(pa.array(hit + 1))], ["a", "b"])

    counted = _hashed(prep).mapInArrow(run, "a string, b string").groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"))
    return counted.join(pairs, ["a", "b"], "left_semi")


def _flat(b: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, hashes, offsets by row) of a batch of (block_id, w, h)."""
    w, h = b.column(1), b.column(2)
    offsets = w.offsets.to_numpy() - w.offsets[0].as_py() if len(w) else np.zeros(1, int)
    return w.flatten(), h.flatten().to_numpy(zero_copy_only=False), offsets


def joins(prep: DataFrame, vocab: DataFrame, found: DataFrame) -> DataFrame:
    """(block_id, left, right, joined): words divided by a line end whose joined form is written undivided elsewhere."""
    cut = divided(prep)
    forms = cut.select("left", "right", F.lower(F.concat("left", "right")).alias("whole"), F.lower(F.concat_ws("-", "left", "right")).alias("compound")).distinct()
    lower = vocab.groupBy(F.lower("word").alias("w")).agg(F.sum("n").alias("n"))
    known = forms.join(lower.select(F.col("w").alias("whole"), F.col("n").alias("n_whole")), "whole", "left").join(
        lower.select(F.col("w").alias("compound"), F.col("n").alias("n_compound")), "compound", "left"
    ).select("left", "right", "whole", F.coalesce("n_whole", F.lit(0)).alias("n_whole"), F.coalesce("n_compound", F.lit(0)).alias("n_compound"))
    # a joined word may itself be misread
    repaired = found.filter("usual").select(F.lower("word").alias("whole"), F.lit(True).alias("readable")).distinct()
    ok = known.join(repaired, "whole", "left").filter("(n_whole > 0 and n_whole >= n_compound) or (n_whole = 0 and n_compound = 0 and readable)").select("left", "right")
    return cut.join(ok.distinct(), ["left", "right"]).withColumn("joined", F.concat("left", "right"))


def candidates(prep: DataFrame, vocab: DataFrame) -> DataFrame:
    """:func:`readings` of every word of the blocks, those joined over a line end included."""
    joined = prep.select(F.explode("words").alias("word")).filter(F.col("word").contains(JOINED)).select(F.replace("word", F.lit(JOINED), F.lit("")).alias("word"))
    every = vocab.unionByName(joined.groupBy("word").agg(F.count(F.lit(1)).alias("n"))).groupBy("word").agg(F.sum("n").alias("n"))
    return written(readings(every, vocab))


def misreadings(prep: DataFrame, vocab: DataFrame, found: DataFrame) -> DataFrame:
    """(block_id, word, true_word): misread words and, with a null true word, misread numbers.

    A usual confusion of an ordinary word is believed by frequency alone. A name
    must stand beside a name that its true form is known beside, or a word that
    is its true form's in three of ten places; an ordinary word is one that is also written in small letters. An unusual
    confusion needs a known neighbour on both sides, and that the word itself is
    not known beside them; so none is found at the ends of a block. Of several candidates the one best known beside the
    neighbours counts, then the usual, then the more frequent.
    """
    said = written(places(prep, found.select("word").distinct()))
    where = said.select("word", "previous", "following").distinct().join(found, "word")
    beside = lambda w: F.array(F.struct(F.col("previous").alias("a"), F.col(w).alias("b")), F.struct(F.col(w).alias("a"), F.col("following").alias("b")))
    pairs = where.select(F.explode(F.concat(beside("true_word"), beside("word"))).alias("p")).select("p.a", "p.b").filter("a is not null and b is not null").distinct()
    k = pair_counts(prep, pairs)
    count = lambda name, a, b: k.select(F.col("a").alias(a), F.col("b").alias(b), F.col("k").alias(name))
    known = (
        where.join(count("before", "previous", "true_word"), ["previous", "true_word"], "left").join(count("after", "true_word", "following"), ["true_word", "following"], "left")
        .join(count("own_before", "previous", "word"), ["previous", "word"], "left").join(count("own_after", "word", "following"), ["word", "following"], "left")
        .fillna(0, ["before", "after", "own_before", "own_after"])
    )
    small = vocab.filter(F.col("word").rlike(r"^\p{Ll}")).select(F.col("word").alias("small"), F.col("n").alias("n_small"))
    known = known.withColumn("small", F.lower("true_word")).join(small, "small", "left").fillna(0, ["n_small"])
    capital = F.col("word").rlike(r"^\p{Lu}\p{Ll}") | F.col("word").rlike(r"^\p{Lu}+$")
    name = capital & ~F.col("word").rlike(r"[!0-9|]") & (F.col("n_small") < RATIO * F.col("n"))
    strong = lambda side, own: (F.col(side) >= 2) & (F.col(side) >= 10 * F.col(own))
    beside_name = lambda side, other: (F.col(side) >= 2) & (F.col(other).rlike(r"^\p{Lu}") | (F.col(side) >= 0.3 * F.col("n_true")))
    near_name = beside_name("before", "previous") | beside_name("after", "following")
    unusual = strong("before", "own_before") & strong("after", "own_after") & (F.length("word") > 1)
    believed = F.when(F.col("usual"), ~name | near_name).otherwise(~name & unusual)
    best = F.max_by("true_word", F.struct("usual", F.col("before") + F.col("after"), "n_true", "true_word"))
    spots = ["word", "previous", "following"]
    chosen = known.filter(believed).groupBy(*spots).agg(best.alias("true_word"))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}")) for c in spots[1:]]
    words = said.alias("s").join(chosen.alias("c"), [F.col("s.word") == F.col("c.word"), *same]).select("block_id", "s.word", "true_word")
    broken = F.pandas_udf(lambda lists: lists.map(lambda ws: [w for w in ws if number_misread(w)]), "array<string>")
    numbers = prep.select("block_id", F.filter("words", lambda w: w.rlike(r"\d") & w.rlike(r"[OoIlBS|]")).alias("w")).filter(F.size("w") > 0).select(
        "block_id", F.explode(broken("w")).alias("word")
    ).withColumn("true_word", F.translate("word", "OoIlBS|", "0011851"))
    return words.unionByName(numbers).distinct()


def noise(blocks: DataFrame) -> DataFrame:
    """(block_id, noise_kind) of every kind of noise in every block."""
    prep = prepared(blocks)
    vocab = written(vocabulary(prep))
    found = candidates(prep, vocab)
    kinds = prep.select("block_id", F.explode("kinds").alias("noise_kind"))
    return kinds.unionByName(joins(prep, vocab, found).select("block_id", F.lit("hyphen").alias("noise_kind"))).unionByName(
        misreadings(prep, vocab, found).select("block_id", F.lit("misread").alias("noise_kind"))
    ).distinct()


def reflowed(blocks: DataFrame) -> DataFrame:
    """(block_id, repaired_text, repaired_search_text, page_label): continuous paragraphs without furniture, divisions and misread words, also on one line."""
    prep = prepared(blocks)
    vocab = written(vocabulary(prep))
    found = candidates(prep, vocab)
    fixes = joins(prep, vocab, found).select("block_id", F.struct(F.lit("join").alias("how"), F.col("left").alias("a"), F.col("right").alias("b")).alias("fix")).unionByName(
        misreadings(prep, vocab, found).filter("true_word is not null").select("block_id", F.struct(F.lit("read").alias("how"), F.col("word").alias("a"), F.col("true_word").alias("b")).alias("fix"))
    ).distinct().groupBy("block_id").agg(F.array_sort(F.collect_list("fix")).alias("fixes"))
    labels = blocks.select("block_id", "printed_page").dropDuplicates(["block_id"])
    whole = prep.drop("words").join(fixes, "block_id", "left").join(labels, "block_id", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = []
            for body, fix in zip(f["body"], f["fixes"], strict=True):
                for x in [] if fix is None else fix:
                    if x["how"] == "join":
                        body = re.sub(rf"\b{re.escape(x['a'])}{BREAK}\n{re.escape(x['b'])}\b", x["a"] + x["b"], body)
                body = re.sub(rf"(\w)[-‐]\n(\w)", r"\1-\2", body)
                for x in [] if fix is None else fix:
                    if x["how"] == "read":
                        body = re.sub(rf"(?<!\w){re.escape(x['a'])}(?!\w)", x["b"].replace("\\", r"\\"), body)
                texts.append("\n\n".join(re.sub(r"\s+", " ", p).strip() for p in re.split(r"\n\s*\n", body)))
            labels = [clean_label(None if p is None or p != p else p) for p in f["printed_page"]]
            yield frame(block_id=f["block_id"], repaired_text=texts, repaired_search_text=[re.sub(r"\s+", " ", t) for t in texts], page_label=labels)

    return whole.mapInPandas(run, "block_id string, repaired_text string, repaired_search_text string, page_label string")
