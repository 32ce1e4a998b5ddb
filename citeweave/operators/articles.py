"""Articles and citation events from structured article XML.

Python does only what needs the order of mixed content: one pass of events over a document gives its fields, its
references, and its paragraphs as text with a mark at each bibliographic cross-reference.  Sentences, events, regular-expression
fallbacks and counts are column functions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions import text as X
from citeweave.functions.values import squeeze, truthy, try_int

#: A cross-reference's mark: its number between two characters of private use.
OPEN, CLOSE = "", ""
_REF = "struct<ref_id:string,pmids:array<string>,dois:array<string>,title:string,chapter:string,journal:string,year:string,raw:string>"
_PARAGRAPH = "struct<idx:int,section:string,in_table:boolean,in_fig:boolean,text:string,rids:array<string>>"
_TREE = (
    "subset string, member string, pmc array<string>, pmids array<string>, dois array<string>, title string, any_title string, journal string, "
    f"year_epub string, year_ppub string, year_any string, license_type string, license_text string, refs array<{_REF}>, paragraphs array<{_PARAGRAPH}>"
)


@dataclass
class _Text:
    """Collects the text below an element; ``lead`` only up to its first child."""

    depth: int
    done: object
    lead: bool = False
    parts: list = field(default_factory=list)
    open: bool = True


@dataclass
class _Section:
    title: str | None = None
    asked: bool = False


@dataclass
class _Paragraph:
    idx: int
    sections: list
    in_table: bool
    in_fig: bool
    parts: list = field(default_factory=list)
    rids: list = field(default_factory=list)


class ArticleReader:
    """Turns the events of one document into a row; ``row`` is None if it has no article."""

    def __init__(self):
        self.tags: list[str] = []
        self.at: int | None = None  # depth of the article
        self.closed = False
        self.slots: dict = {}
        self.ids: dict = {"pmc": [], "pmid": [], "doi": []}
        self.refs: list[dict] = []
        self.texts: list[_Text] = []
        self.sections: list[_Section | None] = []
        self.ref: dict | None = None
        self.ref_depth = 0
        self.target: tuple[str, int] | None = None
        self.paragraphs: list[_Paragraph] = []
        self.inside: list[tuple[int, _Paragraph]] = []
        self.tail: _Paragraph | None = None  # a paragraph that just closed: text up to the next tag follows it
        self.mute = 0  # depth of the cross-reference whose text is left out

    def read(self, data: bytes) -> ArticleReader:
        parser = expat.ParserCreate()
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = self.start, self.end, self.chars
        parser.Parse(data, True)
        return self

    # Paths are tests on the open tags, so nothing but the open tags is kept of the tree.
    def below(self, tag: str) -> bool:
        return tag in self.tags[self.at + 1 : -1]

    def top(self) -> str:
        """The article's child that we are in."""
        return self.tags[self.at + 1] if len(self.tags) > self.at + 1 else ""

    def collect(self, done, lead: bool = False) -> None:
        self.texts.append(_Text(len(self.tags), done, lead))

    def slot(self, name: str) -> None:
        if name not in self.slots:
            self.slots[name] = None
            self.collect(lambda t, n=name: self.slots.__setitem__(n, t))

    def start(self, tag: str, attrs: dict) -> None:
        self.tail = None
        for t in self.texts:
            t.open = t.open and not t.lead
        self.tags.append(tag)
        if self.at is None:
            if tag == "article" and not self.closed:
                self.at = len(self.tags) - 1
            return
        parent = self.tags[-2]
        if self.below("front"):
            self.start_front(tag, attrs, parent)
        if self.top() == "back":
            self.start_back(tag, attrs)
        if self.top() == "body":
            self.start_body(tag, attrs, parent)

    def start_front(self, tag: str, attrs: dict, parent: str) -> None:
        if tag == "article-id" and self.top() == "front":
            kind = attrs.get("pub-id-type", "").lower()
            if kind in ("pmc", "pmcid", "pmid", "doi"):
                self.collect(self.ids["pmc" if kind == "pmcid" else kind].append, lead=True)
        elif tag == "article-title":
            self.slot("any_title")
            if parent == "title-group":
                self.slot("title")
        elif tag == "journal-title":
            self.slot("journal")
        elif tag == "pub-date":
            self.date = attrs.get("pub-type")
        elif tag == "year" and parent == "pub-date":
            self.slot("year_any")
            if self.date in ("epub", "ppub"):
                self.slot(f"year_{self.date}")
        elif tag == "license" and "license-type" in attrs:
            self.slots.setdefault("license_type", attrs["license-type"])
        elif tag == "license-p" and parent == "license":
            self.slot("license_text")

    def start_back(self, tag: str, attrs: dict) -> None:
        if tag == "ref" and self.ref is None:
            self.ref = {"ref_id": attrs.get("id", ""), "raw": None}
            self.ref_depth = len(self.tags)
            self.collect(lambda t, r=self.ref: r.__setitem__("raw", t))
            return
        if self.ref is None:
            return
        depth = len(self.tags) - self.ref_depth
        if depth == 1 and tag in ("element-citation", "mixed-citation") and tag not in self.ref:
            self.ref[tag] = {"pmids": [], "dois": []}
            self.target = (tag, len(self.tags))
        elif self.target:
            into = self.ref[self.target[0]]
            if tag == "pub-id":
                kind = attrs.get("pub-id-type", "").lower()
                if kind in ("pmid", "doi"):
                    self.collect(into[f"{kind}s"].append, lead=True)
            elif depth == 2 and tag in ("article-title", "chapter-title", "source", "year") and tag not in into:
                into[tag] = None
                self.collect(lambda t, i=into, n=tag: i.__setitem__(n, t))

    def start_body(self, tag: str, attrs: dict, parent: str) -> None:
        if tag == "sec":
            self.sections.append(_Section())
        elif tag == "title" and parent == "sec" and self.sections and not self.sections[-1].asked:
            self.sections[-1].asked = True
            self.collect(lambda t, s=self.sections[-1]: setattr(s, "title", t))
        elif tag == "p":
            p = _Paragraph(len(self.paragraphs), self.sections[::-1], self.below("table-wrap"), self.below("fig"))
            self.paragraphs.append(p)
            self.inside.append((len(self.tags), p))
        elif tag == "xref" and attrs.get("ref-type") == "bibr" and not self.mute:
            for _, p in self.inside:
                p.parts.append(f"{OPEN}{len(p.rids)}{CLOSE}")
                p.rids.append(attrs.get("rid", ""))
            self.mute = len(self.tags)

    def end(self, tag: str) -> None:
        depth, self.tail = len(self.tags), None
        for t in [t for t in self.texts if t.depth == depth]:
            t.done("".join(t.parts))
            self.texts.remove(t)
        if self.at is not None:
            if self.mute == depth:
                self.mute = 0
            if self.inside and self.inside[-1][0] == depth:
                self.tail = self.inside.pop()[1]
            if tag == "sec" and self.top() == "body":
                self.sections.pop()
            if self.target and self.target[1] == depth:
                self.target = None
            if self.ref is not None and self.ref_depth == depth:
                self.refs.append(self.ref)
                self.ref = None
            if self.at == depth - 1:
                self.at, self.closed = None, True
        self.tags.pop()

    def chars(self, data: str) -> None:
        for t in self.texts:
            if t.open:
                t.parts.append(data)
        if not self.mute:
            for _, p in self.inside:
                p.parts.append(data)
            if self.tail is not None:
                self.tail.parts.append(data)

    def row(self) -> dict | None:
        if not self.closed:
            return None
        refs = []
        for r in self.refs:
            c = r.get("element-citation") or r.get("mixed-citation") or {"pmids": [], "dois": []}
            refs.append({"ref_id": r["ref_id"], "pmids": c["pmids"], "dois": c["dois"], "title": c.get("article-title"), "chapter": c.get("chapter-title"), "journal": c.get("source"), "year": c.get("year"), "raw": r["raw"]})
        paragraphs = []
        for p in self.paragraphs:
            if p.rids:
                title = next((s.title for s in p.sections if s.title and s.title.strip()), None)
                paragraphs.append({"idx": p.idx, "section": title, "in_table": p.in_table, "in_fig": p.in_fig, "text": "".join(p.parts), "rids": p.rids})
        names = ("title", "any_title", "journal", "year_epub", "year_ppub", "year_any", "license_type", "license_text")
        return {"pmc": self.ids["pmc"], "pmids": self.ids["pmid"], "dois": self.ids["doi"], **{n: self.slots.get(n) for n in names}, "refs": refs, "paragraphs": paragraphs}


class _Tolerant(HTMLParser):
    """Feeds an ``ArticleReader`` with a document that isn't well-formed: end tags close what is open inside them or are left out."""

    def __init__(self, reader: ArticleReader):
        super().__init__(convert_charrefs=True)
        self.reader, self.open = reader, []
        self.CDATA_CONTENT_ELEMENTS = self.RCDATA_CONTENT_ELEMENTS = ()  # the names mean nothing special in articles

    def handle_starttag(self, tag, attrs):
        self.open.append(tag)
        self.reader.start(tag, {k: v or "" for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open:
                last = self.open.pop()
                self.reader.end(last)
                if last == tag:
                    break

    def handle_data(self, data):
        if self.open:
            self.reader.chars(data)


def read_article(data: bytes) -> tuple[dict | None, str]:
    """A document's row and how it was read: ``whole``, ``mended`` if it isn't well-formed, or ``no article`` with no row."""
    how = "whole"
    try:
        row = ArticleReader().read(data).row()
    except expat.ExpatError:
        how, reader = "mended", ArticleReader()
        tolerant = _Tolerant(reader)
        tolerant.feed(data.decode("utf-8", errors="replace"))
        tolerant.close()
        while tolerant.open:
            reader.end(tolerant.open.pop())
        row = reader.row()
    return row, how if row is not None else "no article"


def _trees(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in _TREE.replace("array<struct<", "array<").split(", ")]
    for frame in frames:
        rows = []
        for subset, member, data in zip(frame["subset"], frame["member"], frame["data"], strict=True):
            row, _ = read_article(bytes(data))
            if row is not None:
                rows.append({"subset": subset, "member": member, **row})
        yield pd.DataFrame(rows, columns=columns)


def readings(members: DataFrame) -> DataFrame:
    """Members by how they were read: outcome, n."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"outcome": [read_article(bytes(d))[1] for d in frame["data"]]})

    return members.select("data").mapInPandas(run, "outcome string").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _some(c: Column) -> Column:
    """Squeezed text, null if blank."""
    return F.nullif(squeeze(c), F.lit(""))


def _first(values: Column, test=None) -> Column:
    """The first non-blank value, trimmed; with ``test`` the first whose test isn't null."""
    trimmed = F.filter(F.transform(values, lambda v: squeeze(v)), lambda v: v != "")
    return F.get(trimmed if test is None else F.filter(F.transform(trimmed, lambda v: test(v)), lambda v: v.isNotNull()), 0)


def _int(c: Column) -> Column:
    return try_int(c, "int")


def reference(r: Column, raw_chars: int = 1200) -> Column:
    raw = F.coalesce(squeeze(r["raw"]), F.lit(""))
    return F.struct(
        r["ref_id"].alias("ref_id"),
        F.coalesce(_first(r["pmids"], try_int), X.inline_pmid(raw)).alias("pmid"),
        F.coalesce(_first(r["dois"]), X.inline_doi(raw)).alias("doi"),
        F.coalesce(_some(r["title"]), _some(r["chapter"])).alias("title"),
        _some(r["journal"]).alias("journal"),
        _int(r["year"]).alias("year"),
        F.substring(raw, 1, raw_chars).alias("raw"),
    )


def events(paragraphs: Column, ref_ids: Column) -> Column:
    """Citation events: sentences with a mark that leads to a known reference."""
    mark = f"{OPEN}([0-9]+){CLOSE}"

    def of_sentence(p: Column, s: Column) -> Column:
        rids = F.flatten(F.transform(F.regexp_extract_all(s, F.lit(mark), F.lit(1)), lambda i: F.split(squeeze(F.get(p["rids"], i.cast("int"))), " ")))
        clean = F.regexp_replace(F.trim(F.regexp_replace(s, mark, "")), " {2,}", " ")
        return F.struct(F.filter(rids, lambda r: (r != "") & F.array_contains(ref_ids, r)).alias("ref_ids"), clean.alias("sentence"), _some(p["section"]).alias("section"), p["idx"].alias("paragraph_idx"), p["in_table"].alias("in_table"), p["in_fig"].alias("in_fig"))

    found = F.flatten(F.transform(paragraphs, lambda p: F.transform(X.sentences(squeeze(p["text"])), lambda s: of_sentence(p, s))))
    return F.filter(found, lambda e: F.size(e["ref_ids"]) > 0)


def parse_articles(members: DataFrame) -> DataFrame:
    """Articles from (subset, member, data); documents that aren't well-formed are mended, and those without an article left out (``readings`` counts both)."""
    trees = members.select("subset", "member", "data").mapInPandas(_trees, _TREE)
    pmc = _first(F.col("pmc"))
    year = F.coalesce(*[F.nullif(_int(F.col(c)), F.lit(0)) for c in ("year_epub", "year_ppub")], _int(F.col("year_any")))
    refs = F.filter(F.transform("refs", lambda r: reference(r)), lambda r: truthy(r["ref_id"]))
    rows = trees.select(
        F.when(pmc.startswith("PMC"), pmc).otherwise(F.concat(F.lit("PMC"), pmc)).alias("pmcid"),
        _first(F.col("pmids"), try_int).alias("pmid"),
        _first(F.col("dois")).alias("doi"),
        F.coalesce(_some(F.col("title")), _some(F.col("any_title"))).alias("title"),
        _some(F.col("journal")).alias("journal"),
        year.alias("year"),
        F.coalesce(_some(F.col("license_type")), _some(F.col("license_text"))).alias("license"),
        refs.alias("references"),
        "paragraphs",
        "subset",
        F.col("member").alias("source_xml"),
    )
    rows = rows.withColumn("citations", events(F.col("paragraphs"), F.col("references.ref_id")))
    return rows.select("pmcid", "pmid", "doi", "title", "journal", "year", "license", F.size("references").alias("n_refs"), F.size("citations").alias("n_citations"), "references", "citations", "subset", "source_xml")


def totals(articles: DataFrame) -> DataFrame:
    return articles.agg(F.count(F.lit(1)).alias("n_articles"), F.coalesce(F.sum("n_citations"), F.lit(0)).alias("n_citations"), F.coalesce(F.sum("n_refs"), F.lit(0)).alias("n_refs"))
