"""Readers for sequence, alignment and table files. All paths go through Spark's readers, so
any store that the cluster knows will do."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixmill.functions.sequence import translate_cds
from helixmill.sources import schemas, zips

FASTA_SUFFIXES = ("fna", "fasta", "fa")


def fasta(spark: SparkSession, path: str, glob: str = "*.{fna,fasta}", recursive: bool = False, leading: bool = False) -> DataFrame:
    """(id, description, seq, file): records of FASTA files, split at lines that begin with >.

    Files are read with ">" at the start of a line as the separator of rows, so a large file
    is split between tasks. Files are expected to begin with a header. With `leading` lines
    before a file's first header are left out, which takes a second scan; without it they
    would be read as a record.
    """
    reader = spark.read.option("lineSep", "\n>").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    rows = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    if leading:
        # A file's first row still has its own >, or is no record at all.
        rows = rows.withColumn("row", F.monotonically_increasing_id())
        first = rows.filter("at = 0").groupBy(F.col("file").alias("f")).agg(F.min("row").alias("r"), F.min_by(F.col("value").startswith(">"), "row").alias("headed"))
        rows = rows.join(first.filter("NOT headed"), (F.col("file") == F.col("f")) & (F.col("row") == F.col("r")), "left_anti")
    body = F.regexp_replace("value", "^>", "")
    head = F.regexp_extract(body, r"^([^\r\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace(body, r"^[^\r\n]*", ""), r"[\s]", "")
    named = rows.select(F.split_part(head, F.lit(" "), F.lit(1)).alias("id"), head.alias("description"), seq.alias("seq"), "file")
    return named.filter(F.col("id") != "")


def fastq(spark: SparkSession, path: str, glob: str = "*.{fastq,fq,fastq.gz,fq.gz}", longer_than: int = 0) -> DataFrame:
    """(id, seq, qual, file): reads of four lines, longer than a bound (strictly).

    Files are read with "@" at the start of a line as the separator of rows, so a large file is
    split between tasks, and compressed ones are unpacked by Spark. A quality line may begin
    with @ too: such a read comes in two rows that follow each other, and is put together where
    its task sees both, else by a join of the few rows that end or begin a split.
    """
    rows = spark.read.option("lineSep", "\n@").option("pathGlobFilter", glob).text(path)
    rows = rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held = None, None
        for batch in batches:
            out = []
            for file, at, value in zip(batch["file"], batch["at"], batch["value"], strict=True):
                lines = value.rstrip("\r\n").split("\n")
                if held and (file, at) != place:
                    out.append((*held, *place, "head"))
                    held = None
                place = file, at
                if len(lines) == 1:  # the rest of a quality line that began with @
                    rest = "@" + lines[0].rstrip("\r")
                    out.append((held[0], held[1], rest, file, at, "whole") if held else ("", "", rest, file, at, "tail"))
                    held = None
                    continue
                if held:  # an empty quality line
                    out.append((*held, *place, "whole"))
                    held = None
                head = lines[0].removeprefix("@").split()
                record = head[0] if head else "", lines[1].rstrip("\r"), lines[3].rstrip("\r") if len(lines) > 3 else ""
                if len(lines) > 3:
                    out.append((*record, file, at, "whole"))
                else:
                    held = record
            yield pd.DataFrame(out, columns=["id", "seq", "qual", "file", "at", "part"])
        if held:
            yield pd.DataFrame([(*held, *place, "head")], columns=["id", "seq", "qual", "file", "at", "part"])

    reads = rows.mapInPandas(parse, "id string, seq string, qual string, file string, at long, part string")
    # A split's last head and the next split's first row: the next odd row of the file, if a tail.
    order = Window.partitionBy("file").orderBy("at", F.col("part").desc())
    odd = reads.filter("part <> 'whole'").withColumn("next", F.lead(F.struct("part", "qual")).over(order)).filter("part = 'head'")
    qual = F.when(F.col("next.part") == "tail", F.col("next.qual")).otherwise(F.lit(""))
    out = reads.filter("part = 'whole'").select("id", "seq", "qual", "file").unionByName(odd.select("id", "seq", qual.alias("qual"), "file"))
    return out.filter(F.length("seq") > longer_than)


def single_record(records: DataFrame) -> DataFrame:
    """records, if there is exactly one; else ValueError."""
    if len(records.select("id").limit(2).collect()) != 1:
        raise ValueError("exactly one record is needed")
    return records


def table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A tab-separated file with a header; N/A is null."""
    return spark.read.schema(schema).csv(path, sep="\t", header=True, nullValue="N/A", mode="FAILFAST", enforceSchema=False)


def bare(spark: SparkSession, path: str, schema) -> DataFrame:
    """A tab-separated file without a header: BED, alignment hits."""
    return spark.read.schema(schema).csv(path, sep="\t", header=False, mode="FAILFAST")


def perfect_hits(hits: DataFrame) -> DataFrame:
    """Hits of full identity without gaps, with start and end in the order of the subject."""
    good = hits.filter("pident = 100 AND gapopen = 0")
    return good.withColumn("start", F.least("sstart", "send")).withColumn("end", F.greatest("sstart", "send"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    """The mandatory columns of alignments in SAM text, without header lines."""
    parts = F.split("value", "\t")
    lines = spark.read.text(path).filter(~F.col("value").startswith("@") & (F.col("value") != ""))
    return lines.select(*[F.get(parts, i).cast(f.dataType).alias(f.name) for i, f in enumerate(schemas.SAM.fields)])


def sam_intervals(alignments: DataFrame) -> DataFrame:
    """Mapped alignments as 0-based intervals; the length is the CIGAR's on the reference."""
    steps = F.regexp_extract_all("cigar", F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    length = F.aggregate(steps, F.lit(0).cast("long"), lambda s, n: s + n.cast("long"))
    mapped = alignments.filter((F.col("flag").bitwiseAND(4) == 0) & (F.col("cigar") != "*"))
    return mapped.select(F.col("rname").alias("chrom"), (F.col("pos") - 1).alias("start"), (F.col("pos") - 1 + length).alias("end"))


def exclusive_json(spark: SparkSession, path: str) -> DataFrame:
    """(label, id): the ids of every primer set in a {label: [[id, ...], ...]} file."""
    text = spark.read.text(path, wholetext=True)
    sets = F.from_json("value", "map<string,array<array<string>>>")
    return text.select(F.explode(sets).alias("label", "sets")).select("label", F.explode(F.flatten("sets")).alias("id"))


def zip_members(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """(archive, member, content): the files inside zip archives, of any size.

    Spark lists the archives, and each member is read by its range in its archive (see zips).
    Where only Spark reaches the files, an archive is one row of input, of 2 GB at most. A
    member is a row, so 2 GB bounds members in either case; equal names are rows of their own.
    """
    listed = spark.read.format("binaryFile").load(path)
    paths = [r["path"] for r in listed.select("path").orderBy("path").collect()]
    if zips.reachable(paths):
        return zips.by_members(spark, paths, pattern)
    files = listed.select("path", "content")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        want = re.compile(pattern)
        for batch in batches:
            for archive, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        if want.search(info.filename) and not info.is_dir():
                            yield pd.DataFrame([(archive, info.filename, z.read(info))], columns=schemas.MEMBERS.names)

    return files.mapInPandas(parse, schemas.MEMBERS)


def _coding(text: str) -> Iterator[tuple[str, list[tuple[int, int, int]], str]]:
    """(record id, parts, sequence) per coding feature; parts are 0-based (start, end, strand)."""
    for record in text.split("\n//"):
        name = re.search(r"^VERSION\s+(\S+)", record, re.M) or re.search(r"^LOCUS\s+(\S+)", record, re.M)
        body = re.split(r"^ORIGIN.*$", record, maxsplit=1, flags=re.M)
        if not name or len(body) < 2:
            continue
        seq = re.sub(r"[^A-Za-z]", "", body[1]).upper()
        for place in re.findall(r"^     CDS {13}((?:.*\n {21}(?=[\d<>,()a-z.]))*.*)$", body[0], re.M):
            yield name[1], list(_parts(re.sub(r"\s", "", place))), seq


_PART = re.compile(r"(complement|join|order)?\(|\)|<?(\d+)(?:\.\.>?(\d+))?")


def _parts(place: str) -> Iterator[tuple[int, int, int]]:
    """The spans of a feature's place in the order in which they are read on its strand:
    complement(join(a, b)) is read from b to a, join(complement(b), complement(a)) as written."""
    stack: list[tuple[bool, list[tuple[int, int, int]]]] = [(False, [])]
    for step in _PART.finditer(place):
        text = step[0]
        if text.endswith("("):
            stack.append((step[1] == "complement", []))
        elif text == ")" and len(stack) > 1:
            turned, spans = stack.pop()
            stack[-1][1].extend([(a, b, -strand) for a, b, strand in reversed(spans)] if turned else spans)
        elif step[2]:
            stack[-1][1].append((int(step[2]) - 1, int(step[3] or step[2]), 1))
    yield from stack[0][1]


_TURN = str.maketrans("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")


def genbank_zip(spark: SparkSession, path: str) -> DataFrame:
    """(assembly, record_id, start, end, strand, seq): coding sequences of annotated genomes in
    zip archives, on their own strand; joined spans are put together, each on its strand."""
    members = zip_members(spark, path, r"\.gbff$")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for member, content in zip(batch["member"], batch["content"], strict=True):
                steps = member.split("/")
                rows = []
                for record, spans, seq in _coding(content.decode("utf-8", "replace")):
                    if spans:
                        read = "".join(seq[a:b] if strand > 0 else seq[a:b].translate(_TURN)[::-1] for a, b, strand in spans)
                        low, high = min(x[0] for x in spans), max(x[1] for x in spans)
                        rows.append((steps[-2] if len(steps) > 1 else member, record, low, high, spans[0][2], read))
                yield pd.DataFrame(rows, columns=schemas.CDS.names)

    return members.select("member", "content").mapInPandas(parse, schemas.CDS)


def translated(records: DataFrame) -> DataFrame:
    """Coding sequences, from FASTA files or annotated genomes, with their `protein`."""
    return records.withColumn("protein", translate_cds(F.col("seq")))


def file_labels(spark: SparkSession, groups: list[str], labels: list[str]) -> DataFrame:
    """(accession, label): one row for each record of the FASTA files, with its file's label."""
    if len(groups) != len(labels):
        raise ValueError("as many labels as files are needed")
    out = None
    for path, label in zip(groups, labels, strict=True):
        rows = fasta(spark, path, "*").select(F.col("id").alias("accession"), F.lit(label).alias("label"))
        out = rows if out is None else out.unionByName(rows)
    return out


