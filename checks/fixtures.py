"""Inputs of the operators, derived from the given tables by Spark.

The same derivation is spelled in SQL in ``oracles.py``, from the same base tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.functions.common import explode_rows
from passagemill.functions.text import tokenize
from passagemill.sources.readers import spread
from passagemill.sources.scratch import scratch_path

TEI_HEAD = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body>'
TEI_HEAD_BARE = "<TEI><text><body>"
TEI_TAIL = "</body></text></TEI>"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    scan = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(scan) if name in ("documents", "conversations") else scan


def dirty_text(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, text)`` with links, decomposed letters, footers or wide spaces appended."""
    pages = table(spark, sf, "pages").select((F.col("page_id") * 4).alias("doc_id"), "url")
    docs = table(spark, sf, "documents").join(pages, "doc_id", "left")
    link = F.coalesce("url", F.lit("https://example.org/none"))
    footer = " ORCID: 0000-0001 {} Content not peer-reviewed by ChemRxiv. License: CC BY-NC-ND 4.0 rest"
    kind = F.col("doc_id") % 5
    text = (
        F.when(kind == 0, F.concat("text", F.lit(" see "), link, F.lit(" there")))
        .when(kind == 1, F.concat("text", F.lit(" e\u0301tude")))
        .when((kind == 2) & (F.col("doc_id") % 2 == 0), F.concat("text", F.lit(footer.format("a"))))
        .when(kind == 2, F.concat("text", F.lit(footer.format("a\nb"))))
        .when(kind == 3, F.concat(F.lit("\u00a0 "), "text", F.lit("\u00a0\u2003\t end\u3000")))
        .otherwise(F.col("text"))
    )
    return docs.select("doc_id", text.alias("text"))


def paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    """``(id, pos, paragraph)``: the lines of every document."""
    docs = table(spark, sf, "documents")
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.posexplode(F.split("text", "\n")).alias("pos", "paragraph"),
    )


def _xml_line(line: Column, i: Column) -> Column:
    def escape(c: Column) -> Column:
        c = F.regexp_replace(c, "[\\x00-\\x08\\x0B-\\x1F]", "")
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    cited = F.concat(
        escape(F.left(line, F.lit(10))), F.lit('<ref type="bibr">[1]</ref>'), escape(F.substring(line, 11, 1 << 30))
    )
    return F.concat(F.lit("<p>"), F.when(i % 3 == 0, cited).otherwise(escape(line)), F.lit("</p>"))


def tei_documents(spark: SparkSession, sf: str) -> DataFrame:
    """``(path, doc_id, content)``: four lines per division.

    By id: every 7th document is wrapped in an outer division, every 11th is cut off (not XML),
    every 13th has no namespace.
    """
    docs = table(spark, sf, "documents")
    lines = F.transform(F.split("text", "\n"), _xml_line)
    groups = F.sequence(F.lit(0), F.floor((F.size("l") - 1) / 4))
    divs = F.transform(
        groups,
        lambda g: F.concat(F.lit("<div>"), F.array_join(F.slice("l", (g * 4 + 1).cast("int"), F.lit(4)), ""), F.lit("</div>")),
    )
    body = F.array_join(divs, "")
    key = F.col("doc_id")
    body = F.when(key % 7 == 0, F.concat(F.lit("<div>"), body, F.lit("</div>"))).otherwise(body)
    head = F.when(key % 13 == 0, F.lit(TEI_HEAD_BARE)).otherwise(F.lit(TEI_HEAD))
    tail = F.when(key % 11 == 0, F.lit("</body>")).otherwise(F.lit(TEI_TAIL))
    return docs.select("doc_id", lines.alias("l")).select(
        F.concat(F.lit("/tei/"), key.cast("string"), F.lit(".tei.xml")).alias("path"),
        key.cast("string").alias("doc_id"),
        F.encode(F.concat(head, body, tail), "UTF-8").alias("content"),
    )


def write_files(df: DataFrame, folder: str) -> None:
    """Write ``(name, content)`` rows as one file each, from the tasks."""

    def run(batches):
        from pyarrow import fs

        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                system, path = fs.FileSystem.from_uri(f"{folder}/{name}")
                with system.open_output_stream(path) as out:
                    out.write(content)
            yield batch.select(["name"])

    df.mapInArrow(run, "name STRING").count()


def write_lines(df: DataFrame, folder: str, suffix: str) -> None:
    """Write column ``value`` as one line file per task; a retried task writes the same name."""

    def run(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():05d}{suffix}"
        system, path = fs.FileSystem.from_uri(f"{folder}/{name}")
        with system.open_output_stream(path) as out:
            for batch in batches:
                for line in batch.column(0).to_pylist():
                    out.write(line.encode() + b"\n")
                yield batch.slice(0, 0)

    df.select("value").mapInArrow(run, "value STRING").count()


def tei_folder(spark: SparkSession, sf: str) -> str:
    folder = scratch_path(spark, "tei")
    spark.range(0).write.mode("overwrite").parquet(folder)  # creates the folder
    docs = tei_documents(spark, sf)
    name = F.element_at(F.split("path", "/"), -1)
    write_files(docs.select(name.alias("name"), "content"), _uri(folder))
    return folder


def _uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def unigram_counts(spark: SparkSession, sf: str) -> DataFrame:
    """``(word, n)``: tokens of the benchmark texts."""
    bench = table(spark, sf, "benchmark")
    words = explode_rows(bench, [], tokenize(F.col("text")), "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def unigram_folder(spark: SparkSession, sf: str) -> str:
    """``word,count`` lines: a header, every word of the benchmark twice, larger count last."""
    folder = scratch_path(spark, "counts")
    counts = unigram_counts(spark, sf).filter(~F.col("word").contains(","))
    one = counts.select(F.concat("word", F.lit(","), F.col("n").cast("string")).alias("value"))
    two = counts.select(F.concat("word", F.lit(","), (F.col("n") + 1).cast("string")).alias("value"))
    head = counts.limit(1).select(F.lit("word,count").alias("value"))
    for i, part in enumerate([head, one, two]):
        part.write.text(f"{folder}/{i}")
    return folder


def preprint_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``(value, seq)`` hits: repeated ids, missing ids, cut lines, absent fields."""
    docs = table(spark, sf, "documents")
    names = table(spark, sf, "customer").select(F.col("c_custkey").alias("doc_id"), F.split("c_name", "#").alias("n"))
    rows = docs.join(names, "doc_id", "left")
    key = F.col("doc_id")
    text = key.cast("string")
    words = (
        F.when(key % 5 == 0, F.lit(None))
        .when(key % 5 == 1, F.parse_json(F.lit("[]")))
        .when(key % 5 == 2, F.lit("solo").cast("variant"))
        .otherwise(F.to_variant_object(F.array("lang", "source")))
    )
    first = F.when(key % 6 == 1, F.lit("")).otherwise(F.coalesce(F.get("n", F.lit(0)), F.lit("Anon")))
    last = F.when(key % 6 == 0, F.lit(None)).when(key % 6 == 1, F.lit(" ")).otherwise(F.get("n", F.lit(1)))

    def hit(title: Column) -> Column:
        item = F.struct(
            F.when(key % 30 == 29, F.lit("")).when(key % 30 == 28, F.lit(None)).otherwise(text).alias("id"),
            F.concat(F.lit("10.1/"), text).alias("doi"),
            title.alias("title"),
            F.col("text").alias("abstract"),
            F.lit("2024-01-02T00:00:00Z").alias("publishedDate"),
            F.lit("2024-01-01T00:00:00Z").alias("submittedDate"),
            F.lit("PUBLISHED").alias("status"),
            F.when(key % 2 == 0, F.lit("1")).alias("version"),
            F.when(key % 3 != 0, F.struct(F.lit("CC BY 4.0").alias("name"))).alias("license"),
            words.alias("keywords"),
            F.array(F.struct(first.alias("firstName"), last.alias("lastName")), F.struct(F.lit("Ada").alias("firstName"), F.col("lang").alias("lastName"))).alias("authors"),
            F.when(
                key % 4 != 0,
                F.struct(F.when(key % 4 != 1, F.struct(F.concat(F.lit("https://x/"), text, F.lit(".pdf")).alias("url"))).alias("original")),
            ).alias("asset"),
        )
        return F.to_json(F.struct(item.alias("item")))

    title = F.substring_index("text", "\n", 1)
    once = rows.select(hit(title).alias("value"), key.alias("seq"))
    cut = once.withColumn(
        "value", F.when(F.col("seq") % 40 == 7, F.left("value", F.floor(F.length("value") / 2))).otherwise(F.col("value"))
    )
    again = rows.filter(key % 50 == 0).select(hit(F.lit("second version")).alias("value"), (key + (1 << 40)).alias("seq"))
    return cut.unionByName(again)


def compound_records(spark: SparkSession, sf: str) -> DataFrame:
    """``(Record)`` per part, with its suppliers as references; edge cases by ``p_partkey``."""
    part = table(spark, sf, "part")
    supplier = table(spark, sf, "supplier")
    links = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    rows = links.join(supplier, links.l_suppkey == supplier.s_suppkey)
    per_part = rows.groupBy("l_partkey").agg(
        F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name", "s_nationkey"))).alias("s")
    )
    key = F.col("p_partkey")
    joined = part.join(per_part, key == F.col("l_partkey"), "left").withColumn("s", F.coalesce("s", F.array()))

    def reference(x: Column, name: Column) -> Column:
        number = x["s_suppkey"]
        return F.struct(
            number.alias("ReferenceNumber"),
            name.alias("SourceName"),
            F.concat(F.lit("S"), number.cast("string")).alias("SourceID"),
            F.concat(F.lit("nation "), x["s_nationkey"].cast("string")).alias("Description"),
            F.when(number % 5 != 0, F.concat(F.lit("http://s/"), number.cast("string"))).alias("URL"),
        )

    def info(number: Column, text: Column) -> Column:
        value = F.struct(F.array(F.struct(text.alias("String"))).alias("StringWithMarkup"))
        return F.struct(number.cast("bigint").alias("ReferenceNumber"), value.alias("Value"))

    def texts(*values: Column) -> Column:
        value = F.struct(F.array(*[F.struct(v.alias("String")) for v in values]).alias("StringWithMarkup"))
        return F.array(F.struct(F.lit(None).cast("bigint").alias("ReferenceNumber"), value.alias("Value")))

    def sub(heading: str, information: Column) -> Column:
        return F.struct(F.lit(heading).alias("TOCHeading"), information.alias("Information"))

    none = F.lit(None)
    s = F.col("s")
    old = F.transform(F.slice(s, 1, 1), lambda x: reference(x, F.lit("old")))
    references = F.concat(old, F.transform(s, lambda x: reference(x, x["s_name"])))
    supplied = F.transform(
        s,
        lambda x: info(x["s_suppkey"], F.concat("p_name", F.lit(" from "), x["s_name"])),
    )
    extra = (
        F.when(key % 7 == 0, F.array(info(F.lit(111), F.lit("left out"))))
        .when(key % 7 == 1, F.array(info(F.lit(99999999), F.lit("no reference"))))
        .when(key % 7 == 2, F.transform(F.slice(s, 1, 1), lambda x: info(x["s_suppkey"], F.lit("latest"))))
        .otherwise(F.array())
    )
    empty_subs = F.lit(None)

    def level2(heading: str, information, subs) -> Column:
        return F.struct(F.lit(heading).alias("TOCHeading"), information.alias("Information"), subs.alias("Section"))

    descriptors = F.array(
        F.when(key % 9 != 0, sub("IUPAC Name", texts(F.lower("p_type")))),
        sub("InChI", texts(F.concat(F.lit("InChI="), key.cast("string")))),
        sub("SMILES", texts(F.lit("old"))),
        sub("SMILES", texts(F.col("p_brand"))),
    )
    synonyms = F.array(
        sub("Depositor-Supplied Synonyms", texts(
            F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.lit("12"), F.left("p_name", F.lit(2)), F.left("p_name", F.lit(3)),
            F.lit("ab" * 60), F.lit("a" * 105), F.lit("a\u0661\u0662"), F.lit("1a2"), F.col("p_name"),
        ))
    )
    sections = F.array(
        F.when(key % 7 != 3, level2("Record Description", F.concat(supplied, extra), empty_subs)),
        level2("Computed Descriptors", none, F.array_compact(descriptors)),
        level2("Molecular Formula", texts(F.concat(F.lit("C"), F.col("p_size").cast("string"))), empty_subs),
        F.when(key % 5 != 0, level2("Synonyms", none, synonyms)),
    )
    names = F.struct(F.lit("Names and Identifiers").alias("TOCHeading"), F.array_compact(sections).alias("Section"))
    other = F.struct(F.lit("Structures").alias("TOCHeading"), F.lit(None).alias("Section"))
    record = F.struct(
        key.alias("RecordNumber"),
        F.col("p_name").alias("RecordTitle"),
        references.alias("Reference"),
        F.array(other, names).alias("Section"),
    )
    return joined.select(record.alias("Record"))


def compound_folder(spark: SparkSession, sf: str) -> str:
    """Records as packed ``*.json`` files of one record per line."""
    folder = scratch_path(spark, "compounds")
    compound_records(spark, sf).write.json(folder)
    return folder


def passages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "source", "text")


def passages_in_place(spark: SparkSession, sf: str) -> DataFrame:
    """Passages as the files hold them, in no other partitions."""
    return spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text")


TEMPLATE = 'Ask {{"question": ""}} about\n{text}\nEND $1 \\'


def response_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``(conv_id, turn, kind, value)``: answers to all turns, ten kinds of good and bad."""
    talk = table(spark, sf, "conversations")
    kind = (F.col("conv_id") + F.col("turn")) % 10
    question = F.concat(F.lit("Q "), "text")
    answer = F.to_json(F.struct(question.alias("question"), F.lit(1).alias("extra")))
    content = (
        F.when(kind == 2, F.concat(F.lit("```json\n"), answer, F.lit("\n```")))
        .when(kind == 3, F.concat(F.lit("Here it is: "), answer, F.lit(" done")))
        .when(kind == 4, F.lit('{"question": ""}'))
        .when(kind == 5, F.lit('{"question": null}'))
        .when(kind == 6, F.lit('{"question": 5}'))
        .when(kind == 9, F.lit('{"question": "cut of'))
        .otherwise(answer)
    )
    message = F.array(F.struct(F.struct(content.alias("content")).alias("message")))
    body = F.struct(
        F.when(kind == 1, F.array()).otherwise(message).alias("choices"),
        F.struct(F.when(kind != 4, F.length("text").cast("bigint")).alias("completion_tokens")).alias("usage"),
    )
    line = F.to_json(
        F.struct(
            F.concat(F.col("conv_id").cast("string"), F.lit("__"), F.col("turn").cast("string")).alias("custom_id"),
            F.when(kind == 7, F.lit("rate limit")).alias("error"),
            F.when(kind != 7, F.struct(body.alias("body"))).alias("response"),
        )
    )
    value = F.when(kind == 0, F.left(line, F.lit(25))).otherwise(line)
    return talk.select("conv_id", "turn", kind.cast("int").alias("kind"), content.alias("content"), value.alias("value"))


def cache(spark: SparkSession, sf: str) -> DataFrame:
    """Result cache of the labelled documents; toxic ones failed."""
    labels = table(spark, sf, "labels")
    rows = table(spark, sf, "documents").join(labels, "doc_id")
    failed = F.col("toxic") == 1
    return rows.select(
        F.when(~failed, F.concat(F.lit("Q "), "text")).alias("question"),
        F.struct("doc_id", "source", "text").alias("raw"),
        F.lit(None).cast("string").alias("raw_response"),
        F.when(failed, F.lit(0)).otherwise(F.col("n_chars")).cast("bigint").alias("input_tokens"),
        F.when(failed, F.lit(0)).otherwise(F.lit(7)).cast("bigint").alias("output_tokens"),
        F.lit(0).cast("bigint").alias("reasoning_tokens"),
        F.when(failed, F.lit(0.0)).otherwise((F.col("doc_id") % 100) / 4).alias("latency"),
        F.format_string("2024-01-%02d 10:00", (F.col("doc_id") % 9 + 1).cast("int")).alias("date"),
        F.lit(None).cast("string").alias("reasoning"),
        F.when(failed, F.lit("timeout")).alias("error"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("small-model")).otherwise("large-model").alias("model"),
    )


def stored_names(spark: SparkSession, sf: str) -> DataFrame:
    """``(name)``: stored compound files for most parts, and names that are none."""
    part = table(spark, sf, "part")
    kind = F.col("p_partkey") % 10
    text = F.col("p_partkey").cast("string")
    name = (
        F.when(kind == 0, F.concat(F.lit("note_"), text, F.lit(".json")))
        .when(kind == 1, F.concat(F.lit("cid_"), text, F.lit(".txt")))
        .otherwise(F.concat(F.lit("cid_"), text, F.lit(".json")))
    )
    return part.select(F.col("p_partkey").alias("id"), name.alias("name"))


def job_status(spark: SparkSession, sf: str) -> DataFrame:
    """``(shard, batch_id, status)`` from orders."""
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "in_progress").otherwise("validating")
    return table(spark, sf, "orders").select(
        F.format_string("shard-%03d.jsonl", F.col("o_orderkey")).alias("shard"),
        F.concat(F.lit("batch_"), F.col("o_custkey").cast("string")).alias("batch_id"),
        status.alias("status"),
        F.col("o_orderkey"),
    )


def echo_client_factory():
    """Deterministic stand-in for a generator: asks about the text of the prompt."""

    def client(prompt: str) -> dict:
        text = prompt.split("about\n", 1)[1].rsplit("\nEND", 1)[0]
        if text.startswith("A"):
            raise RuntimeError("refused")
        return {
            "content": [
                {"type": "reasoning_content", "reasoning_content": {"text": "because"}},
                {"type": "tool_use", "input": {"question": "Q " + text}},
            ],
            "input_tokens": len(prompt),
            "output_tokens": 3,
            "latency": 12.345,
        }

    return client


def two_hop_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Passages with two chunks: sound, overlapping, foreign or empty by ``doc_id``."""
    docs = table(spark, sf, "documents")
    kind = F.col("doc_id") % 4
    return docs.select(
        "doc_id",
        "text",
        F.concat(F.lit("Q "), F.col("doc_id").cast("string")).alias("question"),
        F.when(kind == 3, F.lit("")).otherwise(F.left("text", F.lit(20))).alias("chunk1"),
        F.when(kind == 1, F.substring("text", 11, 20))
        .when(kind == 2, F.lit("\u0001 not in any passage"))
        .otherwise(F.substring("text", 31, 20))
        .alias("chunk2"),
    )
