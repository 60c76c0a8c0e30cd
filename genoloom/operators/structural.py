"""Structural variants: caller formats, matching, events, tiers and genes (SV-*).

Normalised columns: ``sv_id, chr1, coord1, chr2, coord2, sv_type, length, caller, qual, pe, sr``,
after them ``sample`` and ``path`` where the lines carry them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions.stats import count_if, sorted_text
from genoloom.functions.text import matched
from genoloom.operators import components, dense
from genoloom.operators.chunks import merged, once, with_totals
from genoloom.operators.intervals import locus_pairs
from genoloom.operators.ordering import with_rank
from genoloom.session import settle

SV_COLUMNS = ("sv_id", "chr1", "coord1", "chr2", "coord2", "sv_type", "length", "caller", "qual", "pe", "sr")


ORIGIN = ("sample", "path")  # where a line comes from; a record's ends are looked for inside it
_KEPT = {c: f"_{c}" for c in ORIGIN}  # beside the records' own ``samples`` and fields


def _origin(rows: DataFrame, names: dict[str, str]) -> list[Column]:
    return [F.col(a).alias(b) for a, b in names.items() if a in rows.columns]


def _records(rows: DataFrame) -> DataFrame:
    """The VCF columns of SV records, split once, and the lines' origin."""
    f = F.col("f")
    # Header and blank lines are told by the fields: a filter on the line would make Spark work the line out again for it.
    blank = (F.size("f") == 1) & (F.trim(f[0]) == "")
    cut = once(rows.select("line", *_origin(rows, _KEPT)), f=F.split("line", "\t")).where(~F.startswith(f[0], F.lit("#")) & ~blank)
    return cut.select(
        *(c for c in cut.columns if c in _KEPT.values()),
        F.regexp_replace(f[0], "^chr", "").alias("chr1"), f[1].cast("bigint").alias("coord1"), f[2].alias("id"),
        f[3].alias("ref"), f[4].alias("alt"), f[5].alias("score"), F.get(f, F.lit(6)).alias("filter"),
        F.concat(F.get(f, F.lit(7)), F.lit(";")).alias("info"), F.get(f, F.lit(8)).alias("fields"),
        F.slice(f, 10, F.greatest(F.size(f) - 9, F.lit(0))).alias("samples"))


def _info(name: str, pattern: str = r"(\d+)") -> Column:
    return matched(F.col("info"), rf"(?:^|;){name}={pattern}")


def _mate() -> Column:
    """Contig and position of the mate in a breakend's ALT, null for other alleles.

    The VCF form is ``bases[contig:pos[`` with either bracket on either side; a contig name may hold
    colons itself, and one outside the reference stands in angle brackets.
    """
    place = F.get(F.split("alt", r"[\[\]]"), F.lit(1))
    pos = F.substring_index(place, ":", -1)
    name = F.substr(place, F.lit(1), F.length(place) - F.length(pos) - 1)
    return F.struct(F.regexp_replace(F.translate(name, "<>", ""), "^chr", "").alias("chrom"), pos.try_cast("bigint").alias("pos"))


def _back(rows: DataFrame) -> list[Column]:
    """The origin columns of records under their own names."""
    return _origin(rows, {b: a for a, b in _KEPT.items()})


def _mates() -> Column:
    """The ids of a record and its mate in either order, where the caller names the mate; else null."""
    mate = _info("MATEID", "([^;]+)")
    return F.when(mate.isNotNull(), F.concat_ws("\t", F.least("id", mate), F.greatest("id", mate)))


def _first_of_pair(df: DataFrame, only: Column) -> DataFrame:
    """Keep one record of each event reported from both ends: the end that sorts first.

    ``only`` marks the rows the rule applies to; the others pass as they are. The choice is a
    grouping on the unordered breakpoint pair within the origin and ``_event``, the caller's own
    name of the event (null where it gives none; dropped here), so it does not depend on file order.
    """
    a = F.struct(F.col("chr1").alias("c"), F.col("coord1").alias("p"))
    b = F.struct(F.col("chr2").alias("c"), F.col("coord2").alias("p"))
    paired = df.where(only)
    cols = [F.col(c) for c in df.columns]
    within = ["sv_type", "_event", *(c for c in ORIGIN if c in df.columns)]
    best = paired.groupBy(*within, F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi")).agg(
        F.min_by(F.struct(*cols), F.struct(a, "sv_id")).alias("_r"))
    return df.where(~only).unionByName(best.select("_r.*")).drop("_event")


def normalise_lumpy(rows: DataFrame) -> DataFrame:
    """SV-1: unplaced contigs and SECONDARY mates dropped; breakends become tra or inv; start <= end."""
    r = _records(rows).where(~F.col("chr1").contains("GL0") & ~F.col("info").contains("SECONDARY"))
    mate = _mate()
    bnd = F.col("info").contains("SVTYPE=BND")
    r = r.where(~(bnd & F.col("alt").contains("GL0")))
    chr2 = F.when(bnd, mate["chrom"]).otherwise(F.col("chr1"))
    end = F.when(bnd, mate["pos"]).otherwise(_info("END").cast("bigint"))
    kind = (
        F.when(~bnd, F.lower(_info("SVTYPE", "([A-Z]+)"))).when(F.col("chr1") != F.col("chr2"), "tra")
        .when(F.col("info").contains("++") | F.col("info").contains("--"), "inv"))
    r = once(r, chr2=chr2, _end=end).withColumn("sv_type", kind).where(F.col("sv_type").isNotNull())
    swap = (F.col("sv_type") != "tra") & (F.col("coord1") > F.col("_end"))
    length = F.when(bnd, F.when(F.col("chr1") == F.col("chr2"), F.abs(F.col("_end") - F.col("coord1"))).otherwise(0)).otherwise(
        F.coalesce(_info("SVLEN", r"-?(\d+)").cast("bigint"), F.lit(0)))
    out = r.select(
        F.regexp_replace("id", r"_\d+$", "").alias("sv_id"), "chr1",
        F.when(swap, F.col("_end")).otherwise(F.col("coord1")).alias("coord1"), "chr2",
        F.when(swap, F.col("coord1")).otherwise(F.col("_end")).alias("coord2"), "sv_type", length.alias("length"),
        F.lit("lumpy").alias("caller"), F.lit(None).cast("double").alias("qual"),
        _info("PE").cast("bigint").alias("pe"), _info("SR").cast("bigint").alias("sr"), *_back(r),
        F.when(F.col("id").rlike(r"_\d+$"), F.regexp_replace("id", r"_\d+$", "")).alias("_event"))
    return _first_of_pair(out, F.col("sv_type") == "tra")


def normalise_delly(rows: DataFrame) -> DataFrame:
    """SV-2: LowQual dropped; an insertion's length and bases come from its consensus."""
    r = _records(rows).where(F.coalesce(F.col("filter"), F.lit("")) != "LowQual")
    kind = _info("SVTYPE", "([A-Z]+)")
    r = once(r, kind=kind, chr2=F.coalesce(matched(F.col("info"), r"CHR2=c?h?r?([0-9XY]+)"), F.col("chr1")),
             _end=F.when(kind == "BND", _mate()["pos"]).otherwise(_info("END").cast("bigint")),
             seq=_info("CONSENSUS", "([A-Z]+)"))
    length = F.when(F.col("kind") == "BND", F.lit(0)).when(F.col("kind") == "INS", F.length("seq")).otherwise(
        F.abs(F.col("_end") - F.col("coord1")))
    bases = F.when(F.col("kind") == "INS", F.concat(F.lit("+"), F.col("seq")))
    return r.select(
        F.col("id").alias("sv_id"), "chr1", "coord1", "chr2", F.col("_end").alias("coord2"),
        F.when(F.col("kind") == "BND", "tra").otherwise(F.lower("kind")).alias("sv_type"), length.cast("bigint").alias("length"),
        F.lit("delly").alias("caller"), _info("MAPQ").cast("double").alias("qual"),
        _info("PE").cast("bigint").alias("pe"), F.coalesce(_info("SR").cast("bigint"), F.lit(0)).alias("sr"), bases.alias("bases"), *_back(r))


def normalise_manta(rows: DataFrame, somatic: bool = False, require_pass: bool = True, human: bool = True) -> DataFrame:
    """SV-3: PASS records on main chromosomes; breakends on one chromosome are inversions.

    Joint calls list paired and split support per sample and count ref / hom / het genotypes;
    somatic calls take the second (tumour) sample.
    """
    r = _records(rows)
    if require_pass:
        r = r.where("filter = 'PASS'")
    if human:
        r = r.where(F.col("chr1").rlike("^[0-9XYM]+") & ~F.col("chr1").contains("random"))
    kind0 = F.lower(_info("SVTYPE", "([A-Z]+)"))
    mate, bnd = _mate(), kind0 == "bnd"
    r = once(
        r, kind0=kind0, chr2=F.when(bnd, mate["chrom"]).otherwise(F.col("chr1")),
        _end=F.when(bnd, mate["pos"]).when(kind0 == "ins", F.col("coord1")).otherwise(
            _info("END").cast("bigint")))
    if human:
        r = r.where(F.col("chr2").rlike("^[0-9XYM]+") & ~F.col("chr2").contains("random"))
    inv = (F.col("kind0") == "bnd") & (F.col("chr1") == F.col("chr2"))
    seq = _info("SEQ", "([A-Z]+)")
    length = F.coalesce(F.when(inv, F.col("_end") - F.col("coord1")), _info("SVLEN", r"-?(\d+)").cast("bigint"),
                        F.when(F.col("kind0") == "ins", F.length(seq)))
    split = F.col("fields").contains("PR:SR")

    def alt_reads(part: Column) -> Column:
        return F.get(F.split(part, ","), F.lit(1))

    def from_end(s: Column, back: int) -> Column:
        return F.try_element_at(F.split(s, ":"), F.lit(-back))

    if somatic:
        tumour = F.get("samples", F.lit(1))
        pe = alt_reads(F.when(split, F.split(tumour, ":")[0]).otherwise(tumour))
        sr = F.when(split, alt_reads(F.get(F.split(tumour, ":"), F.lit(1)))).otherwise("0")
        qual, counts = _info("SOMATICSCORE").cast("double"), F.lit(None).cast("string")
    else:
        pe = F.array_join(F.transform("samples", lambda s: alt_reads(F.when(split, from_end(s, 2)).otherwise(from_end(s, 1)))), ",")
        sr = F.when(split, F.array_join(F.transform("samples", lambda s: alt_reads(from_end(s, 1))), ",")).otherwise("")
        gt = F.transform("samples", lambda s: F.substring_index(s, ":", 1))

        def n(cond) -> Column:
            return F.size(F.filter(gt, cond)).cast("string")

        counts = F.concat(F.lit("Ref="), n(lambda g: g == "0/0"), F.lit(":Hom="), n(lambda g: g == "1/1"), F.lit(":Het="),
                          n(lambda g: ~g.isin("0/0", "1/1")))
        qual = F.col("score").try_cast("double")
    bases = F.when(F.col("kind0") == "ins", F.concat(F.lit("+"), F.coalesce(seq, F.col("alt"))))
    out = r.select(
        F.col("id").alias("sv_id"), "chr1", "coord1", "chr2", F.col("_end").alias("coord2"),
        F.when(inv, "inv").when(F.col("kind0") == "bnd", "tra").otherwise(F.col("kind0")).alias("sv_type"),
        length.cast("bigint").alias("length"), F.lit("manta").alias("caller"), qual.alias("qual"),
        pe.alias("pe"), sr.alias("sr"), counts.alias("sample_count"), bases.alias("bases"),
        *_back(r), _mates().alias("_event"), (F.col("kind0") == "bnd").alias("_bnd"))
    return _first_of_pair(out, F.col("_bnd")).drop("_bnd")


def normalise_long_read(rows: DataFrame, caller: str) -> DataFrame:
    """SV-4: sniffles (``GT:DR:DV``) and pbsv (``GT:AD``) evidence, variant frequency, one end per breakend pair."""
    ev = F.split(F.get("samples", F.lit(0)), ":")
    if caller == "sniffles":
        ref, var = F.get(ev, F.lit(1)), F.get(ev, F.lit(2))
    else:
        ad = F.split(F.get(ev, F.lit(1)), ",")
        ref, var = F.get(ad, F.lit(0)), F.get(ad, F.lit(1))
    kind = F.lower(_info("SVTYPE", "([A-Z]+)"))
    mate = _mate()
    r = once(
        _records(rows), kind=kind, ref_reads=ref.cast("bigint"), var_reads=var.cast("bigint"),
        chr2=F.when(kind == "bnd", mate["chrom"]).otherwise(F.col("chr1")),
        _end=F.when(kind == "bnd", mate["pos"]).otherwise(_info("END").cast("bigint")))
    total = F.col("ref_reads") + F.col("var_reads")
    out = r.select(
        F.col("id").alias("sv_id"), "chr1", "coord1", "chr2", F.col("_end").alias("coord2"),
        F.when(F.col("kind") == "bnd", "tra").otherwise(F.col("kind")).alias("sv_type"),
        _info("SVLEN", r"-?(\d+)").cast("bigint").alias("length"), F.lit(caller).alias("caller"), F.col("filter").alias("status"),
        ev[0].alias("zyg"), "ref_reads", "var_reads",
        F.when(total > 0, F.col("var_reads") / total).otherwise(0.0).alias("var_freq"),
        F.when(F.col("kind") == "ins", F.col("alt")).alias("bases"), *_back(r), _mates().alias("_event"))
    return _first_of_pair(out, F.col("sv_type") == "tra")


def normalise(rows: DataFrame, caller: str) -> DataFrame:
    if caller == "lumpy":
        return normalise_lumpy(rows)
    if caller == "delly":
        return normalise_delly(rows)
    if caller == "manta":
        return normalise_manta(rows)
    return normalise_long_read(rows, caller)


def _spans(sv: DataFrame, name: str) -> DataFrame:
    return sv.select(F.col("chr1").alias("chrom"), "sv_type", F.col("coord1").alias("start"), F.col("coord2").alias("end"),
                     F.col("sv_id").alias(name))


def population_match(sv: DataFrame, population: DataFrame, distance: int) -> DataFrame:
    """SV-5: matches of one type with both ends within the distance; a matched event fails, others are novel.

    ``population`` carries ``chrom, start, end, sv_type, entry``. Matching works on distinct
    spans, so a recurrent event is looked up once.
    """
    keys = ["chrom", "sv_type"]
    spans = _spans(sv, "sv_id")
    loci = spans.select(*keys, "start", "end").distinct()
    pairs = locus_pairs(loci, population.select(*keys, "start", "end", "entry").distinct(), max_distance=distance, keys=keys)
    per = pairs.groupBy(*keys, "start", "end").agg(sorted_text(F.col("entry")).alias("matches"))
    return spans.join(merged(per), [*keys, "start", "end"], "left").select(
        "sv_id", "sv_type", F.coalesce("matches", F.lit("novel")).alias("dgv"),
        F.when(F.col("matches").isNull(), 1).otherwise(0).alias("filterpass"))


SPAN_TYPES = ("del", "dup", "inv")


def caller_pairs(sv: DataFrame, first: str, second: str, distance: int) -> DataFrame:
    """SV-6: matched (sv_id, other) pairs of two callers for del, dup and inv."""
    keys = ["chrom", "sv_type"]
    a = _spans(sv.where((F.col("caller") == first) & F.col("sv_type").isin(*SPAN_TYPES)), "sv_id")
    b = _spans(sv.where((F.col("caller") == second) & F.col("sv_type").isin(*SPAN_TYPES)), "other")
    loci = a.select(*keys, "start", "end").distinct()
    hits = locus_pairs(loci, b, max_distance=distance, keys=keys).select(*keys, "start", "end", "other")
    return a.join(merged(hits), [*keys, "start", "end"]).select("sv_type", "sv_id", "other")


def _ordered_pair(sv: DataFrame) -> DataFrame:
    """Unordered chromosome pair with coordinates in the order of the pair."""
    first = F.col("chr1") < F.col("chr2")
    return sv.select(
        "sv_id", F.least("chr1", "chr2").alias("c_lo"), F.greatest("chr1", "chr2").alias("c_hi"),
        F.when(first, F.col("coord1")).otherwise(F.col("coord2")).alias("start"),
        F.when(first, F.col("coord2")).otherwise(F.col("coord1")).alias("end"),
        *[c for c in sv.columns if c not in SV_COLUMNS])


def _within(a: DataFrame, b: DataFrame, keys: Sequence[str], distance: int) -> DataFrame:
    """Rows of ``a`` with ``b`` rows strictly nearer than the distance at both ends."""
    loci = a.select(*keys, "start", "end").distinct()
    cell = b.withColumnsRenamed({"start": "c_start", "end": "c_end"})
    grid = [F.lit(-1), F.lit(0), F.lit(1)]
    left = loci.withColumn("_s", F.floor(F.col("start") / distance)).withColumn("_e", F.floor(F.col("end") / distance))
    right = (
        cell.withColumn("_ds", F.explode(F.array(*grid))).withColumn("_de", F.explode(F.array(*grid)))
        .withColumn("_s", F.floor(F.col("c_start") / distance) + F.col("_ds"))
        .withColumn("_e", F.floor(F.col("c_end") / distance) + F.col("_de")).drop("_ds", "_de"))
    near = left.join(merged(right), [*keys, "_s", "_e"]).where(
        (F.abs(F.col("start") - F.col("c_start")) < distance) & (F.abs(F.col("end") - F.col("c_end")) < distance))
    return a.join(merged(near.drop("_s", "_e", "c_start", "c_end")), [*keys, "start", "end"])


def translocation_pairs(sv: DataFrame, first: str, second: str, distance: int) -> DataFrame:
    """SV-8: translocations of two callers on the same chromosome pair with both ends nearer than the distance."""
    tra = sv.where("sv_type = 'tra'")
    a = _ordered_pair(tra.where(F.col("caller") == first).select(*[c for c in sv.columns if c in SV_COLUMNS]))
    b = _ordered_pair(tra.where(F.col("caller") == second).select(*[c for c in sv.columns if c in SV_COLUMNS]))
    return _within(a, b.withColumnRenamed("sv_id", "other"), ["c_lo", "c_hi"], distance).select(
        "c_lo", "c_hi", "sv_id", "other")


def group_events(pairs: DataFrame, tra_pairs: DataFrame | None = None, connected: bool = False) -> DataFrame:
    """SV-7: one event per type and distinct list of matched ids, with all its members.

    The event id is the type and the list itself (commas in ids are escaped), so numbering needs no
    global order. Translocations share one event per chromosome pair. A call in several events keeps
    the first id. With ``connected``, calls that are linked over any number of pairs are one event,
    translocations too, and its id is the type and the smallest member.
    """
    if connected:
        links = pairs.select("sv_type", "sv_id", "other")
        if tra_pairs is not None:
            links = links.unionByName(tra_pairs.select(F.lit("tra").alias("sv_type"), "sv_id", "other"))
        ends = [F.struct("sv_type", F.col(c).alias("sv_id")).alias(n) for c, n in (("sv_id", "a"), ("other", "b"))]
        return components.connected(links.select(*ends)).select(
            "node.sv_id", "node.sv_type", F.concat_ws(":", "label.sv_type", "label.sv_id").alias("event_id"))
    escaped = F.regexp_replace("other", r"([\\,])", r"\\$1")
    lists = pairs.groupBy("sv_type", "sv_id").agg(sorted_text(escaped).alias("_list"))
    lists = lists.select("sv_type", "sv_id", F.concat_ws(":", "sv_type", "_list").alias("event_id"))
    members = lists.select("event_id", "sv_type", "sv_id").unionByName(
        pairs.join(merged(lists), ["sv_type", "sv_id"]).select("event_id", "sv_type", F.col("other").alias("sv_id")))
    if tra_pairs is not None:
        t_event = F.concat_ws(":", F.lit("tra"), "c_lo", "c_hi").alias("event_id")
        both = tra_pairs.select(t_event, F.explode(F.array("sv_id", "other")).alias("sv_id"))
        members = members.unionByName(both.withColumn("sv_type", F.lit("tra")))
    return members.groupBy("sv_id", "sv_type").agg(F.min("event_id").alias("event_id"))


def caller_classes(sv: DataFrame, first: str, second: str, distance: int) -> list[dense.MatchClasses]:
    """SV-6 and SV-8 as classes of calls and links between classes: del, dup and inv, then translocations.

    As many rows as calls and a bounded number of cells need, where the pairs of two callers at one
    hot breakpoint would be the product of their calls.
    """
    def of(rows: DataFrame, caller: str, *columns: Column | str) -> DataFrame:
        return rows.where(F.col("caller") == caller).select(*columns, "start", "end", F.col("sv_id").alias("id"))

    plain = sv.where(F.col("sv_type").isin(*SPAN_TYPES)).select(
        F.col("chr1").alias("chrom"), "sv_type", "caller", F.col("coord1").alias("start"), F.col("coord2").alias("end"), "sv_id")
    tra = sv.where("sv_type = 'tra'")
    crossed = _ordered_pair(tra.select("sv_id", "chr1", "coord1", "chr2", "coord2", F.col("caller").alias("_caller"))).withColumnRenamed("_caller", "caller")
    return [dense.match_classes(of(plain, first, "chrom", "sv_type"), of(plain, second, "chrom", "sv_type"), ["chrom", "sv_type"], distance),
            dense.match_classes(of(crossed, first, "c_lo", "c_hi"), of(crossed, second, "c_lo", "c_hi"), ["c_lo", "c_hi"], distance, strict=True)]


def connected_events(sv: DataFrame, first: str, second: str, distance: int) -> DataFrame:
    """SV-7, connected groups straight from calls: (sv_id, sv_type, event_id) of every matched call.

    The same events as ``group_events(connected=True)`` over all pairs, found over classes.
    """
    links, members = [], []
    for part, found, kind in zip("pt", caller_classes(sv, first, second, distance), (F.col("sv_type"), F.lit("tra")), strict=True):
        # Classes of both parts go through the same rounds, told apart by a letter.
        links.append(dense.match_links(found).select(*[F.concat(F.lit(part), n).alias(n) for n in "ab"]))
        members.append(found.members.select(F.concat(F.lit(part), "class").alias("node"), kind.alias("sv_type"), F.col("id").alias("sv_id")))
    labels = components.connected(links[0].unionByName(links[1]))
    calls = settle(members[0].unionByName(members[1]).join(merged(labels), "node").select("sv_type", "sv_id", "label").distinct())
    least = calls.groupBy("sv_type", "label").agg(F.min("sv_id").alias("_first"))
    return calls.join(merged(least), ["sv_type", "label"]).select("sv_id", "sv_type", F.concat_ws(":", "sv_type", "_first").alias("event_id"))


def propagate_status(calls: DataFrame, events: DataFrame) -> DataFrame:
    """SV-9: a call passes only inside an event all of whose members pass; unmatched calls fail.

    ``calls`` carries ``final_status``. Events are judged before the calls meet them, so unmatched
    calls, which have no event, are never dealt out by it.
    """
    at = ["sv_id", "sv_type"]
    own = calls.select(*at, (~F.col("final_status").contains("PASS")).cast("int").alias("_fail"))
    known = events.select(*at, "event_id")
    worst = known.join(merged(own), at).groupBy("event_id").agg(F.max("_fail").alias("_worst"))
    judged = known.join(merged(worst), "event_id", "left")
    return calls.join(merged(judged), at, "left").withColumn(
        "passed", F.coalesce((F.col("_worst") == 0).cast("int"), F.lit(0))).drop("_worst")


def priority_tiers(calls: DataFrame) -> DataFrame:
    """SV-10: HIGH / MEDIUM / LOW / LOWEST, and caller and call counts of the event in its tier.

    ``calls`` carries ``event_id`` (null if unmatched), ``passed, exon_event, gene_event``. A
    passing event with an exon breakpoint in a gene takes its gene-only calls along. Unmatched calls,
    which would all share the null key, stay out of the joins by event.
    """
    calls = settle(calls)
    ok, exon, gene = F.col("passed") == 1, F.col("exon_event") == 1, F.col("gene_event") == 1
    kind = F.col("sv_type")
    matched, rest = calls.where(F.col("event_id").isNotNull()), calls.where(F.col("event_id").isNull())
    lead = matched.where(ok & exon & gene).select("sv_type", "event_id", F.lit(1).alias("_lead")).distinct()
    t = matched.join(merged(lead), ["sv_type", "event_id"], "left")
    tier = (
        F.when(ok & gene & (exon | F.col("_lead").isNotNull()), "HIGH")
        .when(ok & ~exon & gene & kind.isin("del", "dup"), "MEDIUM").when(~ok & exon & gene, "MEDIUM")
        .when(ok & ~exon & kind.isin("tra", "inv"), "LOW").when(~ok & ~exon, "LOWEST").otherwise("NOT_REPORTED"))
    t = t.withColumn("priority", tier).drop("_lead")
    alone = rest.withColumn("_lead", F.lit(None).cast("int")).withColumn("priority", tier).drop("_lead")
    sized = t.groupBy("sv_type", "event_id", "priority", "passed").agg(
        F.count_distinct("caller").alias("_c"), F.count_distinct("sv_id").alias("_n"))
    counted = t.join(merged(sized), ["sv_type", "event_id", "priority", "passed"], "left").unionByName(
        alone.withColumns({"_c": F.lit(None).cast("bigint"), "_n": F.lit(None).cast("bigint")}))
    return (
        counted.withColumn("caller_count", F.coalesce("_c", F.lit(1))).withColumn("call_count", F.coalesce("_n", F.lit(1)))
        .drop("_c", "_n"))


def gene_overlap(sv: DataFrame, genes: DataFrame, exons: DataFrame) -> DataFrame:
    """SV-11: genes under the span, and genes and exons at the two breakpoints, as distinct sorted text.

    Spans of translocations are their two breakpoints.
    """
    def row(c: str, s: str, e: str) -> Column:
        return F.struct(F.col(c).alias("chrom"), F.col(s).cast("bigint").alias("start"), F.col(e).cast("bigint").alias("end"))

    ends = F.array(row("chr1", "coord1", "coord1"), row("chr2", "coord2", "coord2"))
    points = sv.select("sv_id", F.explode(ends).alias("r")).select("sv_id", "r.*")
    spans = sv.select("sv_id", F.explode(F.when(F.col("sv_type") == "tra", ends).otherwise(
        F.array(row("chr1", "coord1", "coord2")))).alias("r")).select("sv_id", "r.*")

    def names(side: DataFrame, ann: DataFrame, col: str, out: str, n: str | None = None) -> DataFrame:
        loci = side.select("chrom", "start", "end").distinct()
        hits = locus_pairs(loci, ann.select("chrom", "start", "end", col).distinct(), bin_width=10_000, longest=0 if out.startswith("breakpoint") else None)
        at = side.join(merged(hits.select("chrom", "start", "end", col)), ["chrom", "start", "end"])
        got = at.groupBy("sv_id").agg(F.collect_set(col).alias("_s"))
        sized = [F.size("_s").cast("bigint").alias(n)] if n else []
        return got.select("sv_id", F.array_join(F.array_sort("_s"), ",").alias(out), *sized)

    return (
        sv.join(merged(names(spans, genes, "gene", "genes", "gene_count")), "sv_id", "left")
        .join(merged(names(points, genes, "gene", "breakpoint_genes")), "sv_id", "left")
        .join(merged(names(points, exons, "exon", "breakpoint_exons")), "sv_id", "left")
        .withColumn("gene_count", F.coalesce("gene_count", F.lit(0)))
        .fillna("NO_EXON_BP", subset=["breakpoint_exons"]))


def genes_to_report(df: DataFrame) -> DataFrame:
    """SV-12: breakpoint genes first, else NO_GENES, else all the span's genes."""
    return df.withColumn(
        "report_genes",
        F.when(F.col("breakpoint_genes").isNotNull(), F.col("breakpoint_genes"))
        .when(F.col("gene_count") == 0, "NO_GENES")
        .otherwise(F.col("genes")))


def gene_summary(hits: DataFrame, gene_info: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SV-13: one row per event and gene with the gene's columns.

    ``hits`` is (sv_id, gene) with a null gene for events without one.
    """
    lone = hits.select("sv_id", "gene").distinct()
    sized = with_totals(lone, ["sv_id"], _n=F.count("gene"))
    shown = sized.select("sv_id", F.when(F.col("_n") == 0, "NO_GENE").otherwise(F.col("gene")).alias("gene")).distinct()
    return shown.join(gene_info.select("gene", *cols), "gene", "left")


def cross_sample_match(sv: DataFrame, members: DataFrame, distance: int, tra_distance: int = 500) -> DataFrame:
    """SV-14: carriers of each proband event in the rest of the family.

    Events of one type match with both ends in range (translocations: a fixed 500). The proband
    counts as affected; affected relatives with a match are added, unaffected ones are counted apart.
    """
    who = members.select("sample", "family", "relation", "affected")
    cols = [c for c in sv.columns if c in SV_COLUMNS]
    tagged = sv.select(*cols, "sample").join(who, "sample")
    proband, other = tagged.where("relation = 'proband'"), tagged.where("relation <> 'proband'")
    keys = ["family", "chrom", "sv_type"]

    def spans(df: DataFrame, name: str) -> DataFrame:
        return df.where("sv_type <> 'tra'").select(
            "family", F.col("chr1").alias("chrom"), "sv_type", F.col("coord1").alias("start"), F.col("coord2").alias("end"),
            F.col("sv_id").alias(name), F.col("sample").alias(f"{name}_sample"), F.col("affected").alias(f"{name}_aff"))

    a, b = spans(proband, "sv_id"), spans(other, "o")
    loci = a.select(*keys, "start", "end").distinct()
    plain = a.join(locus_pairs(loci, b, max_distance=distance, keys=keys), [*keys, "start", "end"]).select(
        "sv_id", "o_sample", "o_aff")
    ta = _ordered_pair(proband.where("sv_type = 'tra'")).select("family", "c_lo", "c_hi", "start", "end", "sv_id")
    tb = _ordered_pair(other.where("sv_type = 'tra'")).select(
        "family", "c_lo", "c_hi", "start", "end", F.col("sample").alias("o_sample"), F.col("affected").alias("o_aff"))
    tra = _within(ta, tb, ["family", "c_lo", "c_hi"], tra_distance).select("sv_id", "o_sample", "o_aff")
    seen = plain.unionByName(tra).distinct().groupBy("sv_id").agg(
        count_if(F.col("o_aff") == 1).alias("_a"), count_if(F.col("o_aff") == 0).alias("_u"),
        sorted_text(F.col("o_sample")).alias("_s"))
    return proband.join(seen, "sv_id", "left").select(
        "family", "sv_id", "sv_type", (F.coalesce("_a", F.lit(0)) + 1).alias("affected_carriers"),
        F.coalesce("_u", F.lit(0)).alias("unaffected_carriers"), F.concat_ws(",", "sample", "_s").alias("samples"))


def rank_family_events(df: DataFrame) -> DataFrame:
    """SV-15: affected carriers descending, unaffected ascending, priority, type, event; adds ``rank``."""
    order = F.when(F.col("priority") == "HIGH", 1).when(F.col("priority") == "MEDIUM", 2).otherwise(3)
    return with_rank(df, [F.desc("affected_carriers"), F.col("unaffected_carriers"), order, F.col("sv_type"), F.col("sv_id")]).orderBy("rank")


def enough_support(df: DataFrame, minimum: int = 4) -> DataFrame:
    """SV-16: split plus paired reads reach the minimum."""
    return df.where(F.coalesce("sr", F.lit(0)) + F.coalesce("pe", F.lit(0)) >= minimum)
