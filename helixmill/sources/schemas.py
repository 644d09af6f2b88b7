"""Explicit schemas of the files that the tools read and write."""

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


FASTA = struct(id=STRING, description=STRING, seq=STRING, file=STRING)
FASTQ = struct(id=STRING, seq=STRING, qual=STRING, file=STRING)
BED3 = struct(chrom=STRING, start=LONG, end=LONG)
BED5 = struct(chrom=STRING, start=LONG, end=LONG, name=STRING, score=INT)
BLAST10 = struct(
    qseqid=STRING, sseqid=STRING, nident=INT, qstart=INT, qend=INT, sstart=LONG, send=LONG, sseq=STRING, slen=LONG, stitle=STRING
)
BLAST12 = struct(
    qseqid=STRING, sseqid=STRING, pident=DOUBLE, length=INT, mismatch=INT, gapopen=INT, qstart=INT, qend=INT,
    sstart=LONG, send=LONG, evalue=DOUBLE, bitscore=DOUBLE,
)
SAM = struct(
    qname=STRING, flag=INT, rname=STRING, pos=LONG, mapq=INT, cigar=STRING, rnext=STRING, pnext=LONG, tlen=LONG, seq=STRING, qual=STRING
)
LABELS = struct(accession=STRING, label=STRING)
GROUPS = struct(accession=STRING, groups=STRING)
KMERS = struct(id=STRING, kmer=STRING)
MATRIX = struct(bin=INT, kmer=STRING, sample_idx=INT, n=LONG)
AMPLICON = struct(
    amplicon_len=INT, HitName=STRING, FP_ID=STRING, FP_seq=STRING, FP_degeneracies=INT, FP_mismatches=INT, RP_ID=STRING,
    RP_seq=STRING, RP_degeneracies=INT, RP_mismatches=INT, RevcompRP=STRING, Start=LONG, End=LONG, Full_Hit_ID=STRING, AmpliconSeq=STRING,
)
PROBE_AMPLICON = T.StructType(
    AMPLICON.fields[:11]
    + struct(
        ProbeID=STRING, Probe_seq=STRING, RevcompProbe=STRING, Probe_degeneracies=INT, Probe_mismatches=INT,
        Probe_startOnAmplicon=INT, ProbeStrand=STRING,
    ).fields
    + AMPLICON.fields[11:]
)
CDS = struct(assembly=STRING, record_id=STRING, start=LONG, end=LONG, strand=INT, seq=STRING)
MEMBERS = struct(archive=STRING, member=STRING, content=T.BinaryType())
