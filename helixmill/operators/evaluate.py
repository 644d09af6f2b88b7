"""Coverage (inclusivity), off-target hits (exclusivity) and summaries of amplicons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmill.functions import sequence as S
from helixmill.operators.tables import released, written

#: Taxon of synthetic constructs, left out of off-target tests.
SYNTHETIC = "32630"


def labelled(amplicons: DataFrame, labels: DataFrame, default: str | None = None) -> DataFrame:
    """Amplicons with their accession's label; unlabelled ones vanish, or get the default."""
    if default is None:
        return amplicons.join(labels, "accession")
    return amplicons.join(labels, "accession", "left").withColumn("label", F.coalesce("label", F.lit(default)))


def lineage(taxa: DataFrame, ranks: list[str]) -> DataFrame:
    """(taxid, rank, ancestor): for every taxon and each of the ranks the nearest taxon of that
    rank among itself and its ancestors.

    taxa: taxid, parent, rank. Parent links are walked by pointer doubling: a taxon that has
    not found its ancestor takes over what its pointer has found, or its pointer's pointer, so
    a chain of n links takes log2(n) rounds of one join each, in all ranks at once. Taxa without
    an ancestor of a rank have no row for it: roots (parent null, itself, or not in the table),
    and those whose links go in a circle without that rank. Of repeated taxids the least
    (parent, rank) counts; null taxids are left out.
    """
    one = taxa.filter("taxid IS NOT NULL").groupBy("taxid").agg(F.min(F.struct("parent", "rank")).alias("x")).select("taxid", "x.parent", "x.rank")
    every = one.select("taxid", F.explode(F.array(*[F.lit(r) for r in ranks])).alias("want"), "parent", "rank")
    found = F.when(F.col("rank") == F.col("want"), F.col("taxid"))
    state = written(every.select("taxid", "want", found.alias("ancestor"), F.when(found.isNull() & (F.col("parent") != F.col("taxid")), F.col("parent")).alias("pointer")))
    rounds = max(1, state.count()).bit_length()
    for _ in range(rounds):
        if state.filter("pointer IS NOT NULL").isEmpty():
            break
        done, todo = state.filter("pointer IS NULL"), state.filter("pointer IS NOT NULL")
        ahead = state.select(F.col("taxid").alias("pointer"), "want", F.col("ancestor").alias("__ancestor"), F.col("pointer").alias("__pointer"))
        moved = todo.join(ahead, ["pointer", "want"], "left").select("taxid", "want", F.col("__ancestor").alias("ancestor"), F.col("__pointer").alias("pointer"))
        old, state = state, written(done.unionByName(moved))
        released(old)
    return state.filter("ancestor IS NOT NULL").select("taxid", F.col("want").alias("rank"), "ancestor")


def with_taxon(rows: DataFrame, accessions: DataFrame, ancestors: DataFrame, subspecies: bool = False) -> DataFrame:
    """rows with label, the species (or subspecies, else species) taxon; "0" if unknown.

    accessions: accession, taxid; ancestors: taxid, rank, ancestor, as `lineage` makes them.
    """
    of = lambda rank: ancestors.filter(F.col("rank") == rank).select("taxid", F.col("ancestor").alias(rank))
    joined = rows.join(accessions, "accession", "left").join(of("species"), "taxid", "left")
    label = F.col("species")
    if subspecies:
        joined = joined.join(of("subspecies"), "taxid", "left")
        label = F.coalesce(F.nullif(F.col("subspecies"), F.lit(0)), label)
    return joined.withColumn("label", F.coalesce(label, F.lit(0)).cast("string")).drop("taxid", "species", "subspecies")


def taxon_name(taxid: Column, names: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair]) if names else None
    return F.lit("Unknown") if table is None else F.coalesce(F.try_element_at(table, taxid), F.lit("Unknown"))


def without(rows: DataFrame, name: str, blacklist: list[str]) -> DataFrame:
    """rows whose name contains none of the patterns."""
    return rows.filter(reduce(lambda a, b: a & b, [~F.col(name).rlike(x) for x in blacklist], F.lit(True)))


def on_target_labels(rows: DataFrame) -> DataFrame:
    """Without unknown taxa and synthetic constructs."""
    return rows.filter(~F.col("label").isin("0", SYNTHETIC))


def coverage(hits: DataFrame, totals: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(label, by..., hits, coverage): distinct accessions hit over the label's accessions.

    totals: label, accession. Labels without hits have 0 hits and null coverage. Accessions
    are made distinct with map-side sums before they are counted.
    """
    size = totals.groupBy("label").agg(F.countDistinct("accession").alias("__total"))
    found = hits.select("label", *by, "accession").distinct().groupBy("label", *by).agg(F.count("*").alias("hits"))
    joined = size.join(found, "label", "left")
    share = F.col("hits") / F.col("__total")
    return joined.select("label", *by, F.coalesce("hits", F.lit(0)).alias("hits"), share.alias("coverage"))


def hit_pivot(hits: DataFrame, columns: list[str], by: str = "primer_group") -> DataFrame:
    """Labels by primer groups, with hit counts and 0 for none; the columns are given, so that
    no extra job looks for them."""
    return hits.groupBy("label").pivot(by, columns).agg(F.count(F.lit(1))).na.fill(0)


def missing(hits: DataFrame, totals: DataFrame) -> DataFrame:
    """(label, accession) of the accessions without a hit."""
    return totals.select("label", "accession").distinct().join(hits.select("label", "accession"), ["label", "accession"], "left_anti")


def exclusive_sets(hits: DataFrame, orgs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For each organism (column label) the primer sets that hit nothing else, and failures.

    hits: primer_set (string), label, accession. Returns (label, primer_set) of exclusive sets
    and (label, primer_set, failure_acc), a row for each off-target accession. A set is
    exclusive to an organism if its least and greatest label are that one: two numbers a set,
    summed on the map side. Organisms are a short list of the caller's.
    """
    names = sorted(r["label"] for r in orgs.select(F.col("label").cast("string").alias("label")).distinct().collect() if r["label"] is not None)
    every = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    spans = hits.groupBy("primer_set").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a = b")
    good = spans.filter(F.array_contains(every, F.col("a").cast("string"))).select(F.col("a").cast("string").alias("label"), "primer_set")
    found = hits.select("primer_set", F.col("label").cast("string").alias("__own"), "accession").distinct()
    bad = found.select(F.explode(F.filter(every, lambda o: o != F.col("__own"))).alias("label"), "primer_set", F.col("accession").alias("failure_acc"))
    return good, bad.distinct()


def failure_lists(failures: DataFrame) -> DataFrame:
    """(label, primer_set, failure_acc): the failures of a set as one sorted list, for writing."""
    return failures.groupBy("label", "primer_set").agg(F.array_sort(F.collect_list("failure_acc")).alias("failure_acc"))


def longer_than(amplicons: DataFrame, least: int) -> DataFrame:
    """Amplicons strictly longer than a bound."""
    return amplicons.filter(F.col("amplicon_len") > least)


def by_probe(amplicons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Amplicons with a probe, and those without, which count as not detected."""
    return amplicons.filter(F.col("ProbeID").isNotNull()), amplicons.filter(F.col("ProbeID").isNull())


def restricted(metadata: DataFrame, records: DataFrame, on: str = "accession") -> DataFrame:
    """Rows of metadata whose accession is a record's id (column id)."""
    return metadata.join(records.select(F.col("id").alias(on)), on, "left_semi")


def packaged(amplicons: DataFrame, column: int = 1, probe: bool = True) -> DataFrame:
    """The fields of exclusivity tests: primer_pair, mismatches, name, primer, accession and
    the primer set (with the probe, where there is one)."""
    ids = [F.col("FP_ID"), F.col("RP_ID"), *([F.col("ProbeID")] if probe and "ProbeID" in amplicons.columns else [])]
    extra = [c for c in ("label", "AmpliconSeq") if c in amplicons.columns]
    return amplicons.select(
        F.concat_ws("_", "FP_ID", "RP_ID").alias("primer_pair"), F.col("FP_mismatches").alias("fp_mismatches"), F.col("RP_mismatches").alias("rp_mismatches"),
        F.col("HitName").alias("name"), S.id_prefix(F.col("FP_ID")).alias("primer"), S.accession(F.col("Full_Hit_ID"), column).alias("accession_num"),
        F.array_join(S.primer_set(*ids), ",").alias("primer_set"), *extra,
    )


def off_target_members(rows: DataFrame, k: int = 3, exact: bool = False) -> DataFrame:
    """(primer_set, profile, label, accession, others): each accession of a k-mer profile (or,
    exact, a sequence) that other labels of its primer set have too, with the number of those.

    rows: primer_set, label, accession, AmpliconSeq. A row an accession and profile, however
    many share it: what an amplicon is off target to is the same for all accessions of its label,
    so it is a number here, and `off_target_failures` lists it once a label. Counts are summed
    on the map side; a profile that is in most genomes is one key of the last join, whose
    large side Spark splits. `others` counts label and accession pairs. Null labels are a label,
    sequences that are null have no profile and no row. Profiles are written once, so that the
    sequences are read once.
    """
    key = F.sha2("AmpliconSeq", 256) if exact else S.composition_key(F.col("AmpliconSeq"), k)
    signed = written(rows.filter("AmpliconSeq IS NOT NULL").select("primer_set", key.alias("profile"), "label", "accession").distinct())
    per_label = signed.groupBy("primer_set", "profile", "label").agg(F.count("*").alias("own"))
    every = per_label.groupBy("primer_set", "profile").agg(F.sum("own").alias("all"), F.count("*").alias("labels")).filter("labels > 1")
    counts = _same(per_label, every, "primer_set", "profile").select("primer_set", "profile", "label", (F.col("all") - F.col("own")).alias("others"))
    return _same(signed, counts, "primer_set", "profile", "label").select("primer_set", "profile", "label", "accession", "others")


def _same(left: DataFrame, right: DataFrame, *on: str) -> DataFrame:
    """An inner join in which nulls are equal; the left's columns and the right's others."""
    named = right.select(*[F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in right.columns])
    return left.join(named, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on])).drop(*[f"__{c}" for c in on])


def off_target_failures(members: DataFrame) -> DataFrame:
    """(primer_set, profile, label, failure_acc): the accessions of other labels that a label's
    amplicons of a profile also occur in, a row each. Rows grow with the members times the
    labels of their profile, not with the square of the members."""
    groups = members.select("primer_set", "profile", "label").distinct()
    theirs = members.select("primer_set", "profile", F.col("label").alias("__other"), F.col("accession").alias("failure_acc"))
    met = _same(theirs, groups, "primer_set", "profile").filter(~F.col("label").eqNullSafe(F.col("__other")))
    return met.select("primer_set", "profile", "label", "failure_acc").distinct()


def off_target_by_composition(rows: DataFrame, k: int = 3, exact: bool = False) -> DataFrame:
    """(primer_set, label, accession, failure_acc): the off-target accessions of every accession
    as one sorted list, for writing. The lists are made once a profile and label and then put
    to the accessions, so only the result itself grows with the square of a profile's members."""
    members = written(off_target_members(rows, k, exact))
    lists = off_target_failures(members).groupBy("primer_set", "profile", "label").agg(F.collect_list("failure_acc").alias("failure_acc"))
    listed = _same(members, lists, "primer_set", "profile", "label")
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("failure_acc"))))
    return listed.groupBy("primer_set", "label", "accession").agg(every.alias("failure_acc"))


def exclusive_json(good: DataFrame, orgs: DataFrame) -> DataFrame:
    """(label, primers): per organism the list of its exclusive sets, empty where it has none."""
    lists = good.groupBy("label").agg(F.sort_array(F.collect_list("primer_set")).alias("primers"))
    out = orgs.select(F.col("label").cast("string").alias("label")).distinct().join(lists, "label", "left")
    return out.withColumn("primers", F.coalesce("primers", F.array().cast("array<string>")))


def summary(amplicons: DataFrame, row: str = "row_id", reference: str | None = None) -> DataFrame:
    """A row per oligo pair: lengths, their difference, melting temperatures, first position.

    reference keeps hits whose name contains it, in any case.
    """
    rows = amplicons
    if reference:
        rows = rows.filter(F.coalesce(F.col("HitName").rlike(f"(?i){reference}"), F.lit(False)))
    first = F.min_by(F.struct("Start", "End"), row).alias("at")
    pairs = rows.dropna(subset=["FP_ID", "RP_ID", "FP_seq", "RP_seq"]).groupBy("FP_ID", "RP_ID", "FP_seq", "RP_seq").agg(first)
    tm = lambda c: S.melting_temperature(F.col(c))
    return pairs.select(
        "FP_ID", "RP_ID", "FP_seq", "RP_seq", F.length("FP_seq").alias("FP_len"), F.length("RP_seq").alias("RP_len"),
        F.abs(F.length("FP_seq") - F.length("RP_seq")).alias("len_diff"), tm("FP_seq").alias("FP_Tm"), tm("RP_seq").alias("RP_Tm"),
        F.abs(tm("FP_seq") - tm("RP_seq")).alias("Tm_diff"), F.col("at.Start").alias("Start"), F.col("at.End").alias("End"),
    )


def with_inclusivity(table: DataFrame, inclusivity: DataFrame, on: str) -> DataFrame:
    """Summary and inclusivity side by side; rows of either alone stay."""
    return table.join(inclusivity, on, "full")


def only_exclusive(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Pairs of which one oligo's prefix is among ids (column id): two semi-joins, no OR."""
    keys = ids.select(F.col("id").alias("__id")).distinct()
    f = table.join(keys, S.id_prefix(F.col("FP_ID")) == F.col("__id"), "left_semi")
    r = table.join(keys, S.id_prefix(F.col("RP_ID")) == F.col("__id"), "left_semi")
    return f.unionByName(r).distinct()
