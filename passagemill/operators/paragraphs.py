"""TEI documents to paragraphs. Only the XML walk itself runs in Python, one Arrow batch a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill import constants as C
from passagemill.functions.common import run_once
from passagemill.operators.work import number_in_group
from passagemill.sources.scratch import stored


def tei_divisions(
    content: Column,
    nfc: bool = False,
    dedupe_nested: bool = False,
    keep_inner_space: bool = False,
) -> Column:
    """``array<array<string>>``: per body division, the texts of its paragraphs.

    Divisions and paragraphs come in document order. A nested division repeats its paragraphs
    in every division around it unless ``dedupe_nested``. Reference contents are left out but
    the text after them stays. Each inline element is trimmed on its own unless
    ``keep_inner_space``. No body gives an empty array, unparsable XML gives null.
    """
    namespace = C.TEI_NAMESPACE

    @F.arrow_udf("array<array<string>>")
    def divisions(documents):
        import unicodedata
        from xml.etree import ElementTree

        import pyarrow as pa

        body, division, paragraph = (f"{{{namespace}}}{n}" for n in ("body", "div", "p"))

        class Events:
            """Collects texts from parser events; ``open`` holds (slot, pieces) per element."""

            def __init__(self):
                self.depth, self.state = 0, "before"
                self.open, self.around, self.divs = [], [], []

            def start(self, tag, attrs):
                self.depth += 1
                if self.state == "before" and tag == body and self.depth > 1:
                    self.state = "inside"
                elif self.state == "inside":
                    slot = []
                    if tag == paragraph:
                        for texts in self.around[-1:] if dedupe_nested else self.around:
                            texts.append(slot)
                    if tag == division:
                        self.divs.append([])
                        self.around.append(self.divs[-1])
                    self.open.append((slot, []))

            def data(self, text):
                if self.open:
                    self.open[-1][1].append(text)

            def end(self, tag):
                self.depth -= 1
                if self.state != "inside":
                    return
                if not self.open:
                    self.state = "after"
                    return
                slot, pieces = self.open.pop()
                text = "".join(pieces)
                if tag == paragraph or not keep_inner_space:
                    text = text.strip()
                if tag == paragraph and text:
                    slot.append(unicodedata.normalize("NFC", text) if nfc else text)
                if tag == division:
                    self.around.pop()
                if self.open and tag.rpartition("}")[2] != "ref":
                    self.open[-1][1].append(text)

            def close(self):
                return [[text for slot in texts for text in slot] for texts in self.divs]

        def walk(data):
            parser = ElementTree.XMLParser(target=Events())
            try:
                parser.feed(data)
                return parser.close()
            except ElementTree.ParseError:
                return None

        texts = [None if d is None else walk(d) for d in documents.to_pylist()]
        return pa.array(texts, pa.list_(pa.list_(pa.string())))

    return run_once(divisions)(content)


def paragraph_array(divisions: Column, concat_p: bool = False) -> Column:
    """All paragraphs, or per division one text of its paragraphs joined by a line break."""
    if not concat_p:
        return F.flatten(divisions)
    filled = F.filter(divisions, lambda d: F.size(d) > 0)
    return F.transform(filled, lambda d: F.array_join(d, "\n"))


def explode_paragraphs(df: DataFrame, divisions: str = "divisions", concat_p: bool = False) -> DataFrame:
    """One row per paragraph with its document position ``pos``; other columns are kept."""
    rest = [c for c in df.columns if c != divisions]
    found = paragraph_array(F.col(divisions), concat_p)
    return df.select(*rest, F.posexplode(found).alias("pos", "paragraph"))


def number_paragraphs(df: DataFrame, document: str = "path", position: str = "pos") -> DataFrame:
    """``idx``: consecutive number of the kept paragraphs of each document.

    Numbering is per file, so two files sharing an id both start at 0. Rows are counted and numbered
    in two passes, so they are written to the shared folder first and computed once.
    """
    return number_in_group(stored(df, "paragraphs"), [document], position)


def document_arrays(df: DataFrame, doc: str = "id", file: str = "path") -> DataFrame:
    """``(path, id, paragraphs)``: one row per file, its paragraphs in order.

    Files that share an id stay apart. A file was one row before its paragraphs were spread, so
    its array is bounded as well.
    """
    pairs = F.array_sort(F.collect_list(F.struct("idx", "paragraph")))
    names = [] if doc == file else [F.first(doc).alias(doc)]
    return df.groupBy(file).agg(*names, F.transform(pairs, lambda p: p["paragraph"]).alias("paragraphs"))


def all_document_arrays(documents: DataFrame, df: DataFrame, doc: str = "id", file: str = "path") -> DataFrame:
    """Like :func:`document_arrays`, with an empty array for files without paragraphs."""
    arrays = document_arrays(df, doc, file).select(file, "paragraphs")
    found = documents.select(*dict.fromkeys([file, doc])).dropDuplicates([file]).join(arrays, file, "left")
    return found.withColumn("paragraphs", F.coalesce("paragraphs", F.array().cast("array<string>")))


def corpus_stats(arrays: DataFrame) -> DataFrame:
    """One row ``(rejected, kept, unparsed)`` over per-document counts, without a shuffle of text."""
    return arrays.agg(
        F.coalesce(F.sum(F.col("n_found") - F.col("n_kept")), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum("n_kept"), F.lit(0)).alias("kept"),
        F.count_if(F.col("n_found").isNull()).alias("unparsed"),
    )
