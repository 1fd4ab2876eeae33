"""Template residue and error-page text (problem 10).

Labelled exemplars (`exemplars`: some 150 short passages in the wording of public notices in ten languages, a fixed number) stand under an
inverted index that every worker holds. A text is cut to passage windows (lines, sentences, at most WINDOW words) of terms (words cut to
STEM letters, pairs of signs where no spaces are written, one term for every unfilled slot). A window is looked up by its telling
terms and scored by TF-IDF containment: the share of the window's weight that the exemplars retrieved for it cover, by document
frequencies of the whole corpus.

Windows covered by RESIDUE, and by no ABOUT exemplar more, count against the text's content, which is what is left without titles, menus and markup;
a text is excluded where they cover most of it. A window with a slot is scored over what speaks of slots alone: the slot, which the UNFILLED
exemplars cover, and the terms that only EXPLAINED exemplars have, which they don't. So a slot amid ordinary words counts, and one
in a sentence about placeholders, syntax or blanks doesn't; one slot that counts is enough.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideglass.llm.exemplars import ABOUT, ELEMENTS, EXPLAINED, FRAME, GENRE_MARKS, RESIDUE, SLOT, UNFILLED
from tideglass.session import materialise

WINDOW = 40
STEM = 5
#: Share of a window's weight, and of a text's content, from which they count as residue.
COVERED, EXCLUDED = 0.65, 0.5
#: Share of a window's telling terms that an exemplar must have to be scored.
RETRIEVED, SEVERAL = 0.2, 6
#: Terms of an EXPLAINED exemplar that a window must have for it to be retrieved.
EXPLAINS = 2
# Words that don't retrieve, of the exemplars' languages.
COMMON = frozenset(
    "the a an of to in on and or for with is are was be by at from it its this that as has have not no your you we our which who i s t "
    "d l la le les de des du un une à est été ce nous vous el los las en y que por para no se o al lo su der die das und ist in zu den ein eine von mit für nicht il di e che per non è i o os um uma em when where how such like then must can may will be are het een van niet är en det att w na z i в на и не".split()
)

#: Words are runs of letters that touch no digit: codes and numbers have none.
_RUN = re.compile(r"\w+|\ue000")
_NO_SPACES = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")
_NAME = r"[\p{L}_][\p{L}\p{N}_.]*(?: [\p{L}\p{N}_.]+){0,3}"
#: What may follow a name in a slot: filters and defaults.
_FILTER = r"(?:\s*\|\s*[^{}<>|\n]{1,40}){0,4}"
_TAGS = "|".join(ELEMENTS)
_MARKS = "|".join(m.replace(" ", r"\s+") for m in GENRE_MARKS)
#: Slots, longest forms first. A name in braces that closes a JSON member, a formula between dollars and a quoted slot are none.
_SLOTS = regex.compile(
    r"(?=[{<%$#@\[_«|&(])(?:"
    + "|".join(
        (
            rf"(?<![\"“`$])\$?\{{\{{+[>#/^&!~-]*\s*{_NAME}{_FILTER}\s*\}}+\}}(?![\"”`])",
            rf"<%[=-]?\s*{_NAME}\s*[-]?%>",
            rf"\{{%-?\s*(?!endraw){_NAME}\s*-?%\}}",
            rf"(?<!`)\$\{{\s*{_NAME}\s*\}}(?![$`])",
            rf"#\{{\s*{_NAME}\s*\}}",
            rf"(?<![\w:\"`{{$])\{{(?!\w\}}){_NAME}{_FILTER}\}}(?![\"`])",
            r"(?<![\w:{])\{\d{1,2}\}",
            rf"\[\[\s*{_NAME}\s*\]\]",
            rf"<<\s*{_NAME}\s*>>",
            rf"(?:<|&lt;)(?!/|(?i:(?:{_TAGS})\b)){_NAME}(?:>|&gt;)",
            rf"@@\s*{_NAME}\s*@@|@\{{{_NAME}\}}",
            r"(?<!\w)__\p{L}[\p{L}\p{N}_. ]{0,40}?__(?!\w)",
            rf"%\({_NAME}\)[sdfr]|(?<![\w%])%(?:[-+]?\d*\.?\d*)[sdf]\b(?!\w)",
            rf"%%\s?{_NAME}\s?%%|(?<![\w|<])\|{_NAME}\|(?![\w|>])|«{_NAME}»",
            r"%[A-Z][A-Z_]{2,}%|%[a-z]+_[a-z_]+%|%\{[\w.]+\}",
            r"\$[A-Z][A-Z_]+(?: [A-Z]+)?\$",
            rf"\$(?:[\p{{Ll}}]+[\p{{Lu}}_][\p{{L}}_.]*|[\p{{L}}]+_[\p{{L}}_.]+)\$|\$[\p{{Ll}}][\p{{L}}_. ]{{2,30}}\$",
            r"\[(?i:insert|your|enter|add|fill in|replace|placeholder)\b[^\]\n]{0,60}\]",
            r"\[(?i:to come|tbd|tbc|tk|to be (?:confirmed|determined|added|completed))\]",
            rf"\[(?!(?i:{_MARKS})\])[A-Z][A-Z]+(?:[ _/.][A-Z]+){{0,4}}\]",
            r"\[(?:[A-Z][\p{Ll}']+ ){0,3}(?:Name|Date|Address|Title|Amount|Number|Company|City|State|Country|Email|Phone)\]",
            r"\[\s*(?:_{2,}|●|•|x{2,}|X{2,}|\.{3}|…|\?+)\s*\]",
            r"(?<!\w)_{4,}(?!\w)",
            r"\[object Object\]|\[OBJECT OBJECT\]|\[object object\]|#REF!|#VALUE!|#NAME\?|#DIV/0!|#N/A\b|#NULL!|#NUM!|#ref!|#value!|#n/a\b|#div/0!",
            r"\((?:null|none|undefined)\)",
        )
    )
    + ")"
)
#: Marks that are words; a text without the letters in HINTS has none.
_MARKED = re.compile(r"\b(?:TKTK|tktk|X{4,}|XXX|xxxx+|XX\.XX|xx\.xx)\b|(?<![\w.])NaN(?![\w.]*\w)|(?<!\w)undefined(?!\w)")
HINTS = ("NaN", "undefined", "TKTK", "tktk", "XXX", "xxxx", "XX.XX", "xx.xx")
_NULLS = re.compile(r"(?<![\w\"':])null(?![\w\"':]| and void| hypothesis)|(?<=[a-z$,(] )None(?![\w\"':]| of\b)")
_SHOUTED = re.compile(r"\b(?:NAN|UNDEFINED|NULL|nan)\b")
_TITLE = regex.compile(r"<title>.*?</title>", regex.I | regex.S)
_MARKUP = regex.compile(rf"<!--.*?-->|<\?.*?\?>|</?(?i:{_TAGS})\b[^<>]*>|<!(?i:doctype)[^>]*>|</[^<>]*>|&(?:nbsp|amp|quot|#\d+);", regex.S)
_SPACE = re.compile(r"[^\S\n]{2,}|[^\S\n ]")
_HIDDEN = regex.compile(r"[\p{Cc}\p{Cf}--[\n\t\r]]+", regex.V1)
_STOP = re.compile(r"[.!?…][\"”»)]?\s+|[。！？][\"”»)]?\s*")
_BLOCK = re.compile(r"\n\s*\n")
_END = re.compile(r"[.!?…。:;,\"”»)]$")
_COMPANY_END = re.compile(r"\b(?:Inc|Co|Corp|Ltd|plc|Group|Bros|Cie)\.$", re.I)


def words(text: str) -> list[str]:
    return [w for w in _RUN.findall(text.lower()) if w == SLOT or w.isalpha()]


@lru_cache(maxsize=1 << 17)
def _terms(word: str) -> tuple[str, ...]:
    if word == SLOT:
        return (word,)
    if not word.isalpha():
        return ()
    if word < "\u3040" or not _NO_SPACES.search(word):
        return (word[:STEM],)
    return tuple(word[i : i + 2] for i in range(max(len(word) - 1, 1)))


def terms_of(text: str) -> list[str]:
    """Words cut to STEM letters; of scripts without spaces the pairs of neighbouring signs; SLOT once for each slot."""
    return [t for w in _RUN.findall(text.lower()) for t in _terms(w)]


def sentences(line: str) -> list[str]:
    out, at = [], 0
    for m in _STOP.finditer(line):
        out.append(line[at : m.end()].strip())
        at = m.end()
    out.append(line[at:].strip())
    return [s for s in out if s]


def windows(text: str) -> list[str]:
    """Lines cut to sentences, and these to pieces of at most WINDOW words."""
    out = []
    for line in text.split("\n"):
        for s in sentences(line):
            if s.count(" ") < WINDOW:
                out.append(s)
            else:
                parts = s.split(" ")
                out += [" ".join(parts[i : i + WINDOW]) for i in range(0, len(parts), WINDOW)]
    return out


class Index:
    """The exemplars and their inverted index."""

    def __init__(self) -> None:
        common = {w[:STEM] for w in COMMON}
        bag = lambda passages: [frozenset(terms_of(x)) for x in passages]
        self.bags = bag((*RESIDUE, *ABOUT))
        self.residue = len(RESIDUE)
        self.frame = {w for x in FRAME for w in words(x)}
        postings = defaultdict(list)
        for i, terms in enumerate(self.bags):
            for w in terms - common:
                postings[w].append(i)
        self.postings, self.common = dict(postings), common
        #: What tells that a slot is spoken of, not left unfilled.
        plain = frozenset().union(*bag(UNFILLED)) | common
        self.explained = [terms - plain for terms in bag(EXPLAINED)]
        self.explains = frozenset().union(*self.explained)

    def retrieve(self, terms: list[str]) -> list[int]:
        """Exemplars that have RETRIEVED of the window's telling terms, and at least one, or two of SEVERAL or more. Those of ABOUT must also be there
        by half of their own terms: a bare notice isn't yet a sentence that discusses one."""
        telling = set(terms) - self.common
        hits = telling & self.postings.keys()
        least = RETRIEVED * len(telling) if len(telling) < SEVERAL else max(RETRIEVED * len(telling), 2)
        if 2 * len(hits) <= len(telling):  # exemplars that together have no more than half of them don't count
            return []
        found: dict[int, int] = {}
        for w in hits:
            for i in self.postings[w]:
                found[i] = found.get(i, 0) + 1
        near = [i for i, k in found.items() if k >= least]
        return [i for i in near if i < self.residue or 2 * len(self.bags[i].intersection(terms)) >= len(self.bags[i])]

    def notice(self, terms: list[str]) -> bool:
        """Whether exemplars of residue have COVERED of a line's telling terms."""
        telling = set(terms) - self.common
        held = frozenset().union(*(self.bags[i] for i in self.retrieve(terms) if i < self.residue))
        return bool(telling) and len(telling & held) >= COVERED * len(telling)

    def scored(self, terms: list[str], slot: bool) -> list[tuple[str, list[str], list[bool]]]:
        """(kind, terms, whether the exemplars cover each) of what is to be weighed of a window: `residue` by all exemplars of
        RESIDUE together, as a window may run two notices together, if they have most of its telling terms; `about` by each other exemplar; `slot` by UNFILLED."""
        near = self.retrieve(terms)
        out: list[tuple[str, list[str], list[bool]]] = []
        if not near and not slot:
            return out
        own = sorted(set(terms))
        bad = frozenset().union(*(self.bags[i] for i in near if i < self.residue))
        telling = set(own) - self.common
        if 2 * len(telling & bad) > len(telling):
            out.append(("residue", own, [w in bad for w in own]))
            out += [("about", own, [w in self.bags[i] for w in own]) for i in near if i >= self.residue]
        if slot:
            known = self.explains.intersection(own)
            speakers = [terms for terms in self.explained if len(terms & known) >= EXPLAINS]
            speaks = [SLOT, *sorted(frozenset().union(*speakers) & known)]
            out += [("about", own, [w == SLOT or w in self.common or w in terms for w in own]) for terms in speakers]
            out.append(("slot", speaks, [w == SLOT for w in speaks]))
        return out


@lru_cache(maxsize=1)
def index() -> Index:
    return Index()


def read(text: str) -> tuple[list[tuple[str, int, bool]], int]:
    """(window, letters, has a slot) of the text's content and the length of the title that stands above it, if there is one.

    Markup, page titles and frames are gone. A first line of its own is a title if it fits a window and has no full stop (but that of a company)."""
    text = _SLOTS.sub(f" {SLOT} ", _HIDDEN.sub("", text.replace("\r\n", "\n")))
    if any(h in text for h in HINTS):
        text = _MARKED.sub(SLOT, text)
    if text == text.upper() or text == text.lower():
        text = _SHOUTED.sub(SLOT, text)
    if "null" in text or "None" in text:
        text = _NULLS.sub(SLOT, text)
    if "<" in text or "&" in text:
        text = _MARKUP.sub("\n", _TITLE.sub("\n", text))
    text = _SPACE.sub(" ", text)
    frame = index().frame
    blocks = [b for b in _BLOCK.split(text) if b.strip()]
    kept = []
    for block in blocks:
        lines = [x.strip() for x in block.split("\n") if x.strip()]
        lines = [x for x in lines if not _only_frame(x, frame)]
        if lines:
            kept.append(lines)
    title = 0
    if len(kept) > 1 and len(kept[0]) == 1 and SLOT not in kept[0][0]:
        head = kept[0][0]
        if head.count(" ") < WINDOW and (not _END.search(head) or _COMPANY_END.search(head)) and "{" not in head and not index().notice(terms_of(head)):
            title = len(head)
            kept = kept[1:]
    out = []
    for lines in kept:
        for w in windows("\n".join(lines)):
            size = len(w) - w.count(" ")
            if size:
                out.append((w, size, SLOT in w))
    return out, title


_FIRST = re.compile(r"[^\W\d_]+")


def _only_frame(line: str, frame: set[str]) -> bool:
    """Whether all words of a line are those of menus; most lines are known by their first word not to be."""
    first = _FIRST.search(line)
    if first is None or first[0].lower() not in frame:
        return False
    return frame.issuperset(words(line))


#: kind `residue`, `about` or `slot`: a window to be weighed; `term`: the batch's texts that have it (in size); `texts`: the batch's texts.
CANDIDATE = "doc bigint, window bigint, size bigint, content bigint, kind string, passage bigint, terms array<string>, covered array<boolean>"


def _retrieve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The windows to be weighed, and how many of the batch's texts have each term. Each text is read once."""
    look = index()
    for part in batches:
        rows, texts, frequency = [], 0, Counter()
        for doc, text in zip(part.iloc[:, 0], part.iloc[:, 1], strict=True):
            if text is None:
                continue
            texts += 1
            if not text or text.isspace():
                continue
            found, _ = read(text)
            content = sum(size for _, size, _ in found)
            seen: set[str] = set()
            for at, (window, size, slot) in enumerate(found):
                terms = terms_of(window)
                seen.update(terms)
                for kind, own, covered in look.scored(terms, slot):
                    passage = xxhash.xxh3_64_intdigest(f"{kind} {' '.join(own)} {covered}") - 2**63
                    rows.append((doc, at, size, content, kind, passage, own, covered))
            frequency.update(seen)
        rows += [(None, -1, n, 0, "term", 0, [w], None) for w, n in frequency.items()]
        rows.append((None, -1, texts, 0, "texts", 0, None, None))
        out = pd.DataFrame(rows, columns=["doc", "window", "size", "content", "kind", "passage", "terms", "covered"])
        yield out.astype({"doc": "Int64"})


def residue_scores(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, coverage, slots, is_residue of every text in which a window retrieved an exemplar or has a slot; other texts, and null,
    empty and blank ones, have no row: nothing in them is residue. Keys are whole numbers and unique; rows with a null key have none.

    coverage: the share of the content's letters in windows of which the exemplars of RESIDUE cover COVERED of the weight and none of
    ABOUT covers more. slots: windows of whose weight about slots the slot itself has COVERED."""
    c = F.col
    read_ = documents.where(c(key).isNotNull()).select(c(key).cast("bigint"), text).mapInPandas(_retrieve, CANDIDATE)
    read_ = materialise(read_, "residue-windows")
    n = read_.where(c("kind") == "texts").agg(F.sum("size").alias("n")).first()["n"] or 0
    weighed = read_.where(c("kind").isin("residue", "about", "slot"))
    # Notices recur: each different passage is weighed once.
    passages = weighed.groupBy("passage").agg(F.any_value("terms").alias("terms"), F.any_value("covered").alias("covered"))
    pairs = passages.select("passage", F.explode(F.arrays_zip("terms", "covered")).alias("x")).select("passage", c("x.terms").alias("term"), c("x.covered").alias("covered"))
    frequency = read_.where(c("kind") == "term").groupBy(c("terms")[0].alias("term")).agg(F.sum("size").alias("df"))
    idf = frequency.select("term", (F.log((n + 1.0) / (c("df") + 1.0)) + 0.1).alias("idf"))
    share = (F.sum(F.when(c("covered"), c("idf")).otherwise(0.0)) / F.sum("idf")).alias("share")
    shares = pairs.join(idf, "term").groupBy("passage").agg(share)
    most = lambda kind: F.max(F.when(c("kind") == kind, c("share")).otherwise(0.0)).alias(kind)
    windows_ = weighed.drop("terms", "covered").join(shares, "passage").groupBy("doc", "window", "size", "content").agg(most("residue"), most("about"), most("slot"))
    bad = (c("residue") >= COVERED) & (c("residue") > c("about"))
    sums = windows_.groupBy(c("doc").alias(key)).agg((F.sum(F.when(bad, c("size")).otherwise(0)) / F.max("content")).alias("coverage"), F.count_if(c("slot") >= COVERED).alias("slots"))
    return sums.withColumn("is_residue", (c("slots") > 0) | (c("coverage") >= EXCLUDED))


def without_residue(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """documents without the texts that are residue, all columns; null, empty and blank texts stay."""
    bad = residue_scores(documents, key, text).where("is_residue").select(key)
    return documents.join(bad, key, "left_anti")
