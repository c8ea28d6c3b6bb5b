"""One query for each operator over the driver's tables in genomic roles, each beside an independent SQL statement."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locuslake.config import Bins, Config, Depth, Phase
from locuslake.functions import columns as C
from locuslake.operators import alignments, binning, counts, depth, features, genetics, genotype, intervals, lift, masks, phasing
from locuslake.plans import stages
from locuslake.plans.fixtures import ctes, role
from locuslake.plans.tables import dropped, scratch, stored
from locuslake.schema import standard
from locuslake.sources import bam, bgzf, bigwig, readers, writers

BUCKET = 1 << 14  # for these roles' intervals of 2 to 60 kb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(roles: str, oracle: str | None = None):
    """Register a function of the named roles; the oracle reads the same names as views."""
    names = roles.split()

    def put(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(*[role(spark, sf_dir, n) for n in names])
        if oracle:
            lead = "with recursive" if "recursive" in oracle.split("(")[0].lower() else "with"
            body = oracle.strip()
            body = body[len("recursive"):].strip() if body.lower().startswith("recursive") else body
            ORACLES[f.__name__] = f"{lead} {ctes(*names)}{', ' + body[5:] if body.lower().startswith('with ') else ' ' + body}"
        return f

    return put


GT = """case when least(ad, dp - ad) >= 2 and ad::double / dp >= 0.1::double and ad::double / dp <= 0.9::double then '0/1'
    when ad = dp and dp >= 10 then '1/1' when ad = 0 and dp >= 10 then '0/0' else './.' end"""

# ---- genotypes and statistics ---------------------------------------------------------------------


@query("snp", f"select chrom, pos0, dp, ad, {GT} as gt from snp")
def genotype_calls(snp):
    return genotype.called(snp).select("chrom", "pos0", "dp", "ad", "gt")


@query("snp", f"select chrom, pos0, gt from (select *, dp % 3 as oth, {GT} as gt from snp) where gt in ('0/1', '1/1') and oth = 0")
def genotypes_kept(snp):
    return genotype.kept(genotype.called(snp.withColumn("oth", F.col("dp") % 3)), True, True).select("chrom", "pos0", "gt")


@query("snp", "select chrom || '_' || (pos0 + 1)::varchar as snp_id, 'AD=' || ad::varchar || ';DP=' || dp::varchar || ';OTH=' || (dp % 3)::varchar as info from snp")
def variant_text(snp):
    return genotype.vcf_lines(snp.withColumn("oth", F.col("dp") % 3)).select("snp_id", "info")


@query("obs", f"""with m as (select chrom, pos0, modality, dp, ad, row_number() over (partition by chrom, pos0, modality order by k1, k2, k3, dp, ad, sample_id) as r from obs),
    u as (select chrom, pos0, sum(dp)::bigint as dp, sum(ad)::bigint as ad, bool_or(modality = 'F') as has_dna, bool_or(modality = 'O') as has_rna from m where r = 1 group by chrom, pos0),
    c as (select *, {GT} as gt from u)
    select coalesce(chrom, 'TOTAL') as chrom, count(*) filter (has_dna) as n_first, count(*) filter (has_rna) as n_second, count(*) filter (has_dna and has_rna) as n_shared, count(*) as n_union,
      count(*) filter (gt = '0/1') as n_het, count(*) filter (gt = '1/1') as n_hom_alt, count(*) filter (gt = '0/0') as n_hom_ref, count(*) filter (gt = './.') as n_dropped, count(*) filter (gt in ('0/1', '1/1')) as n_kept
    from c group by rollup (chrom)""")
def snp_statistics(obs):
    parts = {"dna": obs.where("modality = 'F'"), "rna": obs.where("modality = 'O'")}
    both = counts.merged_modalities(parts, ["dp", "ad"], order=["k1", "k2", "k3", "dp", "ad", "sample_id"])
    return genotype.statistics(genotype.called(both))


@query("variant", """select chrom, count(*) as total, count(*) filter (gt in ('0|1', '1|0')) as het_phased, count(*) filter (gt in ('0/1', '1/0')) as het_unphased,
    count(*) filter (gt in ('1|1', '1/1')) as hom_alt, count(*) filter (gt in ('0|0', '0/0')) as hom_ref from variant group by chrom""")
def germline_statistics(variant):
    return genotype.germline_statistics(variant)


@query("variant", "select chrom, pos0, gt, substr(gt, 3, 1)::tinyint::int as phase from variant where gt in ('0|1', '1|0')")
def phased_het(variant):
    d = genotype.phased_het(variant.withColumns({"ref": F.lit("A"), "alt": F.lit("C")}))
    return d.select("chrom", "pos0", "gt", F.col("phase").cast("int").alias("phase"))


# ---- count tables -----------------------------------------------------------------------------------


@query("snp_sample obs", """with n as (select chrom, pos0, max(dp) as dp, count(*) as c from obs where sample_id = 'N' group by chrom, pos0)
    select p.chrom, p.pos0, coalesce(case when n.c = 1 then n.dp end, 0)::bigint as dp from (select distinct chrom, pos0 from snp_sample where sample_id = 'A') p left join n using (chrom, pos0)""")
def align_counts(snp_sample, obs):
    return counts.aligned(snp_sample.where("sample_id = 'A'").select("chrom", "pos0").distinct(), obs.where("sample_id = 'N'"), ["dp"])


@query("obs", "select chrom, pos0, dp, ad, k1 from (select *, row_number() over (partition by chrom, pos0 order by k1, k2, k3, dp, ad) as r from obs) where r = 1")
def dedup_first(obs):
    return counts.first_of(obs, ["chrom", "pos0"], ["k1", "k2", "k3", "dp", "ad"]).select("chrom", "pos0", "dp", "ad", "k1")


@query("obs", "select chrom, pos0, dp, ad from (select *, count(*) over (partition by chrom, pos0) as c from obs) where c = 1")
def dedup_all(obs):
    return counts.singles(obs, ["chrom", "pos0"]).select("chrom", "pos0", "dp", "ad")


@query("obs", """with k as (select chrom, pos0, count(*) as c from obs group by chrom, pos0)
    select chrom, sum(c)::bigint as n_rows, count(*) as n_keys, count(*) filter (c > 1) as n_repeated, coalesce(sum(c) filter (c > 1), 0)::bigint as n_repeated_rows from k group by chrom""")
def duplicate_accounting(obs):
    return counts.duplicate_counts(obs, ["chrom"], ["chrom", "pos0"])


@query("obs", """select chrom, pos0, sum(dp)::bigint as dp, sum(ad)::bigint as ad, bool_or(modality = 'F') as has_dna, bool_or(modality = 'O') as has_rna from obs group by chrom, pos0""")
def modality_merge(obs):
    return counts.merged_modalities({"dna": obs.where("modality = 'F'"), "rna": obs.where("modality = 'O'")}, ["dp", "ad"])


@query("obs", "select chrom, pos0 from obs where modality = 'F' intersect select chrom, pos0 from obs where modality = 'O'")
def shared_keys(obs):
    return obs.where("modality = 'F'").select("chrom", "pos0").intersect(obs.where("modality = 'O'").select("chrom", "pos0"))


@query("cellcount", "select barcode || '_' || rep_id as barcode, rep_id, feature_id, value from cellcount")
def stacked_replicates(cellcount):
    return counts.stacked({r: cellcount.where(F.col("rep_id") == r).drop("rep_id") for r in ("A", "N", "R")}).select("barcode", "rep_id", "feature_id", "value")


@query("snp", "select chrom, pos0, case when phase = 1 then dp - ad else ad end as b, dp - case when phase = 1 then dp - ad else ad end as a from snp")
def phased_counts(snp):
    return counts.phased(snp).select("chrom", "pos0", "b", "a")


@query("snp_sample", "select chrom, pos0, sample_id, sum(ad)::bigint as ad, sum(dp)::bigint as dp, case when sum(dp) > 0 then sum(ad)::double / sum(dp)::double end as af from snp_sample group by chrom, pos0, sample_id")
def allele_freq_sample(snp_sample):
    return counts.frequencies(snp_sample, ["chrom", "pos0", "sample_id"], "ad")


@query("obs", "select chrom, modality, sample_id, sum(ad)::bigint as ad, sum(dp)::bigint as dp, case when sum(dp) > 0 then sum(ad)::double / sum(dp)::double end as af from obs group by chrom, modality, sample_id")
def allele_freq_group(obs):
    return counts.frequencies(obs, ["chrom", "modality", "sample_id"], "ad")


@query("obs", "select chrom, pos0, sum(ad)::bigint as ad, sum(dp)::bigint as dp, case when sum(dp) > 0 then sum(ad)::double / sum(dp)::double end as af from obs group by chrom, pos0")
def allele_freq_pseudobulk(obs):
    return counts.frequencies(obs, ["chrom", "pos0"], "ad")


@query("snp_sample win", """with s as (select s.*, w.start from snp_sample s join win w on s.chrom = w.chrom and s.pos0 >= w.start and s.pos0 < w.stop),
    g as (select * from (select distinct chrom, start from win) cross join (select distinct sample_id from s))
    select g.chrom || ':' || g.start::varchar as bin_id, g.sample_id, coalesce(sum(s.dp), 0)::bigint as dp, coalesce(sum(s.ad), 0)::bigint as ad from g left join s using (chrom, start, sample_id) group by 1, 2""")
def bin_aggregate(snp_sample, win):
    w = win.withColumn("bin_id", F.concat_ws(":", "chrom", F.col("start").cast("string")))
    return counts.binned_grid(intervals.points_in_intervals(snp_sample, w, ["bin_id"], bucket=BUCKET), w, "bin_id", ["sample_id"], ["dp", "ad"])


@query("snp", """with s as (select chrom, phase, sum(case when phase = 1 then dp - ad else ad end)::bigint as b, sum(dp)::bigint as dp from snp group by chrom, phase)
    select chrom, phase, b, dp, case when dp > 0 then b::double / dp::double end as af from s""")
def baf_bins(snp):
    return counts.frequencies(counts.phased(snp), ["chrom", "phase"])


@query("snp", "select min((dp - ad)::double / dp) as least, max((dp - ad)::double / dp) as most, median((dp - ad)::double / dp) as middle, round(avg((dp - ad)::double / dp), 9) as mean from snp where dp > 0")
def reference_bias(snp):
    return counts.reference_bias(snp.withColumn("ref", F.col("dp") - F.col("ad"))).withColumn("mean", F.round("mean", 9))


@query("cellcount", "select 1 - count(*) filter (value <> 0)::double / (count(distinct barcode) * count(distinct feature_id)) as sparsity, count(*) filter (value <> 0) as nonzero from cellcount")
def matrix_sparsity(cellcount):
    return counts.sparsity(cellcount, "barcode", "feature_id", "value")


@query("obs", """with r as (select distinct chrom, pos0, cell as barcode, k1 as umi, case k2 % 4 when 0 then 'A' when 1 then 'C' when 2 then 'G' else 'A' end as base from obs)
    select chrom, pos0, barcode, count(*) filter (base in ('A', 'C')) as dp, count(*) filter (base = 'C') as ad, count(*) filter (base not in ('A', 'C')) as oth from r group by chrom, pos0, barcode""")
def allele_pileup(obs):
    base = F.when(F.col("k2") % 4 == 1, "C").when(F.col("k2") % 4 == 2, "G").otherwise("A")
    return counts.pileup(obs.select("chrom", "pos0", F.col("cell").alias("barcode"), F.col("k1").alias("umi"), base.alias("base"), F.lit("A").alias("ref"), F.lit("C").alias("alt")))


@query("obs", """with r as (select distinct chrom, pos0, cell as barcode, k1 as umi, case k2 % 4 when 0 then 'A' when 1 then 'C' when 2 then 'G' else 'A' end as base from obs),
    p as (select chrom, pos0, barcode, count(*) filter (base in ('A', 'C')) as dp, count(*) filter (base = 'C') as ad, count(*) filter (base not in ('A', 'C')) as oth from r group by chrom, pos0, barcode),
    s as (select chrom, pos0 from p group by 1, 2 having sum(dp) + sum(oth) >= 3 and sum(dp) > 0 and least(sum(ad), sum(dp) - sum(ad))::double / sum(dp)::double >= 0.25::double)
    select p.* from p join s using (chrom, pos0)""")
def filtered_pileup(obs):
    base = F.when(F.col("k2") % 4 == 1, "C").when(F.col("k2") % 4 == 2, "G").otherwise("A")
    return counts.pileup(obs.select("chrom", "pos0", F.col("cell").alias("barcode"), F.col("k1").alias("umi"), base.alias("base"), F.lit("A").alias("ref"), F.lit("C").alias("alt")), 3, 0.25)


@query("cellcount", "select distinct barcode || '_' || rep_id as barcode, rep_id from cellcount")
def barcode_union(cellcount):
    return counts.barcodes_of({r: cellcount.where(F.col("rep_id") == r).select("barcode").distinct() for r in ("A", "N", "R")})


@query("snp_sample win", """select w.chrom || ':' || w.start::varchar as bin_id, s.sample_id, sum(s.dp)::bigint as dp, sum(s.ad)::bigint as ad from snp_sample s join win w on s.chrom = w.chrom and s.pos0 >= w.start and s.pos0 < w.stop group by 1, 2""")
def bin_aggregate_sparse(snp_sample, win):
    w = win.withColumn("bin_id", F.concat_ws(":", "chrom", F.col("start").cast("string")))
    return counts.binned(intervals.points_in_intervals(snp_sample, w, ["bin_id"], bucket=BUCKET), "bin_id", ["sample_id"], ["dp", "ad"])


@query("variant", "select chrom, pos0, gt from variant where gt like '%1%' and pos0 % 50 >= 20 and pos0 % 31 >= 10")
def quality_filter(variant):
    d = variant.withColumns({"ref": F.lit("A"), "alt": F.lit("C"), "qual": (F.col("pos0") % 50).cast("string"), "dp": F.col("pos0") % 31})
    return genotype.quality(d, 20, 10).select("chrom", "pos0", "gt")


# ---- masks -----------------------------------------------------------------------------------------


@query("snp region", "select chrom, pos0 from snp s where exists (select 1 from region r where r.chrom = s.chrom and s.pos0 >= r.start and s.pos0 < r.stop)")
def region_semi(snp, region):
    return masks.in_regions(snp, region, 1 << 22).select("chrom", "pos0")


@query("snp blacklist", "select chrom, pos0 from snp s where not exists (select 1 from blacklist r where r.chrom = s.chrom and s.pos0 >= r.start and s.pos0 < r.stop)")
def blacklist_anti(snp, blacklist):
    return masks.outside(snp, blacklist, BUCKET).select("chrom", "pos0")


@query("snp_sample", "select chrom, pos0 from (select chrom, pos0, count(*) filter (dp >= 5) as c from snp_sample group by chrom, pos0) where c = 3")
def depth_mask(snp_sample):
    return masks.deep_enough(snp_sample, 3, 5)


BETA = """list_sum(list_transform(range(0, (ad + 1)::bigint), lambda j: exp(lgamma(dp + 2) - lgamma(j + 1) - lgamma(dp + 2 - j) + (dp + 1) * ln(0.5::double))))"""


@query("snp_sample", f"""select chrom, pos0 from snp_sample where sample_id = 'N' and round({BETA.replace('(ad + 1)', '(dp - ad + 1)')}, 9) between 0.025 and 0.975""")
def het_balance_mask(snp_sample):
    # the chance of fewer than ref + 1 successes in dp + 1 trials is 1 - CDF, as central as CDF itself
    return masks.balanced(snp_sample.where("sample_id = 'N'"))


@query("snp region blacklist snp_sample", """select s.chrom, s.pos0 from snp s join region r on r.chrom = s.chrom and s.pos0 >= r.start and s.pos0 < r.stop
    where not exists (select 1 from blacklist b where b.chrom = s.chrom and s.pos0 >= b.start and s.pos0 < b.stop) and exists (select 1 from snp_sample n where n.chrom = s.chrom and n.pos0 = s.pos0 and n.sample_id = 'N' and n.dp >= 5)""")
def combined_masks(snp, region, blacklist, snp_sample):
    normal = masks.deep_enough(snp_sample.where("sample_id = 'N'"), 1, 5)
    return masks.all_of(snp, masks.in_regions(snp, region, 1 << 22), masks.outside(snp, blacklist, BUCKET), normal).select("chrom", "pos0")


@query("snp gene exon", """with g as (select s.chrom, s.pos0, min_by(g.gene_id, (g.start, g.stop, g.gene_id)) as gene_id from snp s join gene g on g.chrom = s.chrom and s.pos0 >= g.start and s.pos0 < g.stop group by 1, 2),
    e as (select distinct s.chrom, s.pos0 from snp s join exon x on x.chrom = s.chrom and s.pos0 >= x.start and s.pos0 < x.stop)
    select s.chrom, s.pos0, coalesce(g.gene_id, 'intergenic') as gene_id, case when e.chrom is not null then 'exon' when g.gene_id is not null then 'intron' else 'intergenic' end as feature_type
    from snp s left join g using (chrom, pos0) left join e using (chrom, pos0)""")
def feature_annotation(snp, gene, exon):
    return masks.annotated(snp, gene, exon, BUCKET).select("chrom", "pos0", "gene_id", "feature_type")


@query("snp gene exon", "select distinct s.chrom, s.pos0 from snp s join gene g on g.chrom = s.chrom and s.pos0 >= g.start and s.pos0 < g.stop")
def feature_mask(snp, gene, exon):
    return masks.in_features(snp, gene, BUCKET).select("chrom", "pos0")


@query("snp exon", "select distinct s.chrom, s.pos0 from snp s join exon x on x.chrom = s.chrom and s.pos0 >= x.start and s.pos0 < x.stop")
def exon_mask(snp, exon):
    return masks.exonic(masks.annotated(snp, exon, exon, BUCKET)).select("chrom", "pos0")


@query("snp gene", "select s.chrom, s.pos0, min_by(g.gene_id, (g.start, g.stop, g.gene_id)) as feature_id from snp s left join gene g on s.chrom = g.chrom and s.pos0 >= g.start and s.pos0 < g.stop group by 1, 2")
def snp_feature(snp, gene):
    return masks.with_feature(snp, gene.withColumnRenamed("gene_id", "feature_id"), bucket=BUCKET).select("chrom", "pos0", "feature_id")


@query("snp region", """with d as (select s.chrom, s.pos0, r.region_id, r.start as a, r.stop as z, lag(s.pos0) over w as p, lead(s.pos0) over w as n from snp s join region r on r.chrom = s.chrom and s.pos0 >= r.start and s.pos0 < r.stop window w as (partition by r.region_id order by s.pos0))
    select chrom, pos0, region_id, coalesce(ceil((p + pos0) / 2.0)::bigint, a) as start, coalesce(ceil((pos0 + n) / 2.0)::bigint, z) as stop from d""")
def snp_boundaries(snp, region):
    return masks.boundaries(snp, region, 1 << 22).select("chrom", "pos0", "region_id", "start", "stop")


@query("snp", "select chrom, pos0 from snp where chrom = 'chr3' and pos0 >= 100000 and pos0 <= 300000")
def baf_slice(snp):
    return masks.slice_of(snp, "chr3", 100000, 300000, True).select("chrom", "pos0")


# ---- interval joins and operations -------------------------------------------------------------------


@query("snp win", "select s.chrom, s.pos0, w.start as win_start from snp s left join win w on s.chrom = w.chrom and s.pos0 >= w.start and s.pos0 < w.stop")
def point_in_interval(snp, win):
    return intervals.points_in_intervals(snp, win, ["start"], how="left", bucket=BUCKET).select("chrom", "pos0", F.col("start").alias("win_start"))


@query("snp gene", "select s.chrom, s.pos0, g.gene_id from snp s join gene g on s.chrom = g.chrom and s.pos0 >= g.start and s.pos0 < g.stop")
def point_in_interval_all(snp, gene):
    return intervals.points_in_intervals(snp, gene, ["gene_id"], bucket=BUCKET).select("chrom", "pos0", "gene_id")


@query("snp gene", """select s.chrom, s.pos0, min_by(g.gene_id, (g.start, g.stop, g.gene_id)) as gene_id from snp s left join gene g on s.chrom = g.chrom and s.pos0 >= g.start and s.pos0 < g.stop group by 1, 2""")
def overlap_first(snp, gene):
    return intervals.first_interval(snp, gene, "gene_id", ["chrom", "pos0"], bucket=BUCKET).select("chrom", "pos0", "gene_id")


@query("snp region", "select r.chrom, r.region_id, count(s.pos0) as n_snps from region r left join snp s on s.chrom = r.chrom and s.pos0 >= r.start and s.pos0 < r.stop group by 1, 2")
def snps_by_region(snp, region):
    return intervals.snp_to_region(snp, region, bucket=1 << 22)[1].select("chrom", "region_id", "n_snps")


@query("gene win", """with o as (select g.gene_id, w.start, least(g.stop, w.stop) - greatest(g.start, w.start) as ov from gene g join win w on g.chrom = w.chrom and g.start < w.stop and w.start < g.stop)
    select g.gene_id, (select o.start from o where o.gene_id = g.gene_id order by ov desc, o.start limit 1) as win_start from gene g""")
def largest_overlap(gene, win):
    w = win.withColumn("win_start", F.col("start"))
    return intervals.largest_overlap(gene, w, "win_start", ["gene_id"], BUCKET).select("gene_id", "win_start")


@query("gene region", """with o as (select g.gene_id, r.region_id, least(g.stop, r.stop) - greatest(g.start, r.start) as ov, r.start from gene g join region r on g.chrom = r.chrom and g.start < r.stop and r.start < g.stop)
    select gene_id, region_id as bin_id from (select *, row_number() over (partition by gene_id order by ov desc, start) as r from o) where r = 1""")
def feature_to_block(gene, region):
    f = gene.withColumn("feature_id", F.col("gene_id"))
    return features.blocks(f, region.withColumnRenamed("region_id", "bin_id"), bucket=1 << 22).select("gene_id", "bin_id")


@query("win blacklist", "select chrom, start, stop from win w where not exists (select 1 from blacklist b where b.chrom = w.chrom and b.start < w.stop and w.start < b.stop)")
def window_blacklist_anti(win, blacklist):
    return intervals.without_overlap(win, blacklist, BUCKET).select("chrom", "start", "stop")


@query("gene", """with a as (select *, case when start <= max(stop) over (partition by chrom order by start, stop rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from gene),
    b as (select *, sum(fresh) over (partition by chrom order by start, stop rows unbounded preceding) as island from a)
    select chrom, min(start) as start, max(stop) as stop, string_agg(distinct brand, ',' order by brand) as brand from b group by chrom, island""")
def interval_merge(gene):
    return intervals.merged(gene, "brand")


@query("region blacklist", """with b as (select distinct r.region_id, r.chrom, r.start as a, r.stop as z, b.start as s, b.stop as e from region r join blacklist b on b.chrom = r.chrom and b.start < r.stop and r.start < b.stop),
    m as (select *, max(e) over (partition by region_id order by s, e rows between unbounded preceding and 1 preceding) as p from b),
    gaps as (select chrom, region_id, coalesce(greatest(p, a), a) as start, least(s, z) as stop from m union all select chrom, region_id, greatest(max(e), any_value(a)), any_value(z) from b group by 1, 2
      union all select chrom, region_id, start, stop from region r where region_id not in (select region_id from b))
    select chrom, region_id, start, stop from gaps where start < stop""")
def interval_subtract(region, blacklist):
    return intervals.subtracted(region, blacklist, 1 << 22).select("chrom", "region_id", "start", "stop")


@query("win score", """select w.chrom, w.start, round(greatest(0, least(1, coalesce(avg(s.score), 0))), 9) as mappability from win w left join score s on s.chrom = w.chrom and s.start < w.stop and w.start < s.stop group by w.chrom, w.start""")
def interval_map_mean(win, score):
    return intervals.mean_over(win, score, "score", "mappability", BUCKET).select("chrom", "start", F.round("mappability", 9).alias("mappability"))


@query("win size", "select w.chrom, w.start, w.stop from win w where w.chrom in (select chrom from size)")
def standard_chroms(win, size):
    return intervals.in_order(standard(win, size)).select("chrom", "start", "stop")


@query("win region", "select w.chrom, w.start from win w left join region r on r.chrom = w.chrom and (w.start + w.stop) // 2 >= r.start and (w.start + w.stop) // 2 < r.stop where r.region_id is null order by w.chrom, w.start limit 30")
def unassigned_windows(win, region):
    return intervals.unassigned(intervals.region_by_midpoint(win, region, bucket=1 << 22)).select("chrom", "start")


TILES = """with l as (select *, stop - start as len, ceil((stop - start) / 3001.0)::bigint as n0 from gene),
    m as (select *, case when n0 > 1 and len - (n0 - 1) * 3001 < 1500 then n0 - 1 else n0 end as n from l), t as (select *, unnest(range(0, n)) as i from m)"""


@query("gene", TILES + " select chrom, gene_id, start + i * 3001 as start, case when i = n - 1 then stop else start + (i + 1) * 3001 end as stop from t")
def tile_regions(gene):
    return intervals.tiled(gene, 3001).select("chrom", "gene_id", "start", "stop")


@query("win region", "select w.chrom, w.start, r.region_id from win w left join region r on r.chrom = w.chrom and (w.start + w.stop) // 2 >= r.start and (w.start + w.stop) // 2 < r.stop")
def region_id_midpoint(win, region):
    return intervals.region_by_midpoint(win, region, bucket=1 << 22).select("chrom", "start", "region_id")


@query("score win", """with s as (select s.chrom, s.score, (select max(w.start) from win w where w.chrom = s.chrom and w.start <= (s.start + s.stop) // 2) as begun from score s),
    m as (select chrom, begun as start, round(avg(score), 6) as signal from s where begun is not null group by 1, 2) select w.chrom, w.start, m.signal from win w left join m using (chrom, start)""")
def signal_asof_bin(score, win):
    return intervals.signal_by_window(score, win, "score", "signal", BUCKET).select("chrom", "start", "signal")


@query("read win", """select w.chrom, w.start, w.stop, r.sample_id, sum(least(r.stop, w.stop) - greatest(r.start, w.start))::double / (w.stop - w.start) as depth from win w join read r on r.chrom = w.chrom and r.start < w.stop and w.start < r.stop group by 1, 2, 3, 4""")
def window_depth(read, win):
    return intervals.window_depth(read, win, BUCKET)


@query("win region", """with a as (select w.chrom, w.start, w.stop, r.region_id from win w left join region r on r.chrom = w.chrom and (w.start + w.stop) // 2 >= r.start and (w.start + w.stop) // 2 < r.stop)
    select coalesce(chrom, 'TOTAL') as chrom, count(*) as n, count(distinct region_id) as regions, sum(stop - start)::bigint as covered, median(stop - start)::double as median_size from a group by rollup (chrom)""")
def window_summary(win, region):
    return intervals.window_summary(intervals.region_by_midpoint(win, region, bucket=1 << 22))


@query("gene win", """with c as (select chrom, start, stop, repeat('ACGTG', ((stop - start) // 5 + 1)::int) as seq from gene),
    o as (select w.chrom, w.start, c.start as cs, c.seq, greatest(w.start, c.start) as a, least(w.stop, c.stop) - greatest(w.start, c.start) as ov from win w join c on c.chrom = w.chrom and c.start < w.stop and w.start < c.stop),
    g as (select chrom, start, sum(length(regexp_replace(substr(seq, (a - cs + 1)::int, ov::int), '[^GC]', '', 'g')))::double / sum(ov) as gc from o group by 1, 2)
    select w.chrom, w.start, g.gc from win w left join g using (chrom, start)""")
def gc_content(gene, win):
    chunks = gene.select("chrom", "start", "stop", F.expr("repeat('ACGTG', cast((stop - start) div 5 + 1 as int))").alias("seq"))
    return intervals.gc_fraction(win.drop("gc"), chunks, BUCKET).select("chrom", "start", "gc")


@query("gene region blacklist", """with a as (select *, case when start <= max(stop) over (partition by chrom order by start, stop rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh from gene),
    b as (select *, sum(fresh) over (partition by chrom order by start, stop rows unbounded preceding) as island from a),
    c as (select chrom, min(start) as start, max(stop) as stop, string_agg(distinct gene_id, ',' order by gene_id) as gene from b group by chrom, island),
    l as (select *, stop - start as len, ceil((stop - start) / 267.0)::bigint as n0 from c), m as (select *, case when n0 > 1 and len - (n0 - 1) * 267 < 133 then n0 - 1 else n0 end as n from l),
    t as (select *, unnest(range(0, n)) as i from m), w as (select chrom, gene, start + i * 267 as start, case when i = n - 1 then stop else start + (i + 1) * 267 end as stop from t)
    select w.chrom, w.start, w.stop, w.gene, r.region_id from w join region r on r.chrom = w.chrom and (w.start + w.stop) // 2 >= r.start and (w.start + w.stop) // 2 < r.stop
    where not exists (select 1 from blacklist b where b.chrom = w.chrom and b.start < w.stop and w.start < b.stop)""")
def wes_windows(gene, region, blacklist):
    return intervals.wes_windows(gene.withColumn("gene", F.col("gene_id")), region, blacklist, 267, 1 << 16).select("chrom", "start", "stop", "gene", "region_id")


@query("blacklist region", """with b as (select distinct p.chrom, p.region_id, p.start as a, p.stop as z, b.start as s, b.stop as e from region p join blacklist b on b.chrom = p.chrom and b.start < p.stop and p.start < b.stop),
    m as (select *, max(e) over (partition by region_id order by s, e rows between unbounded preceding and 1 preceding) as q from b),
    g as (select chrom, region_id, coalesce(greatest(q, a), a) as start, least(s, z) as stop from m union all select chrom, region_id, greatest(max(e), any_value(a)), any_value(z) from b group by chrom, region_id
      union all select chrom, region_id, start, stop from region where region_id not in (select region_id from b)),
    l as (select *, stop - start as len, ceil((stop - start) / 1000.0)::bigint as n0 from g where start < stop), n as (select *, case when n0 > 1 and len - (n0 - 1) * 1000 < 500 then n0 - 1 else n0 end as n from l),
    t as (select *, unnest(range(0, n)) as i from n)
    select chrom, start + i * 1000 as start, case when i = n - 1 then stop else start + (i + 1) * 1000 end as stop, region_id from t""")
def wgs_windows(blacklist, region):
    return intervals.wgs_windows(region, blacklist, 1000, 1 << 20)


# ---- features and labels -------------------------------------------------------------------------------


@query("gene", "select brand, min_by(gene_id, (start, gene_id)) as gene_id, min_by(start, (start, gene_id)) as start from gene group by brand")
def gene_first(gene):
    return counts.first_of(gene, ["brand"], ["start", "gene_id"]).select("brand", "gene_id", "start")


@query("cellcount", "with p as (select feature_id, sum(value)::bigint as pseudobulk, count(distinct case when value <> 0 then barcode || rep_id end) as n from cellcount group by 1) select feature_id, pseudobulk, n as n_barcodes from p where pseudobulk > 0 and n >= 99")
def feature_filter(cellcount):
    x = cellcount.withColumn("barcode", F.concat("barcode", "rep_id"))
    return features.expressed(x).join(features.widely_expressed(x, 1980, 0.05), "feature_id")


@query("gene", "select gene_id from gene where brand not in ('Brand#11', 'Brand#12')")
def gene_blacklist(gene):
    black = gene.where(F.col("brand").isin("Brand#11", "Brand#12")).select("brand").distinct()
    return features.without_genes(gene, black, "brand").select("gene_id")


@query("cellcount gene", "select distinct c.feature_id, g.chrom, g.start, g.stop from cellcount c join gene g on 'G' || substr(c.feature_id, 2) = g.gene_id")
def feature_coordinates(cellcount, gene):
    var = cellcount.select(F.concat(F.lit("G"), F.substring("feature_id", 2, 10)).alias("feature_id")).distinct()
    return features.with_coordinates(var, gene).select(F.concat(F.lit("F"), F.substring("feature_id", 2, 10)).alias("feature_id"), "chrom", "start", "stop")


@query("obs", "select 'B' || cell::varchar as barcode, chrom, pos0 // 200000 as tile, count(*) as value from obs group by 1, 2, 3")
def tile_matrix(obs):
    return features.tiles(obs.select(F.concat(F.lit("B"), F.col("cell").cast("string")).alias("barcode"), "chrom", F.col("pos0").alias("start")), 200_000)


# in replicate R a fifth of the features goes by other names, so that not all replicates have all
NAMED = "u as (select case when rep_id = 'R' and feature_id like '%7' then feature_id || 'r' else feature_id end as feature_id, barcode, rep_id, value from cellcount)"


def _named(cellcount):
    own = F.when((F.col("rep_id") == "R") & F.col("feature_id").endswith("7"), F.concat("feature_id", F.lit("r"))).otherwise(F.col("feature_id"))
    return {r: cellcount.where(F.col("rep_id") == r).select(own.alias("feature_id"), "barcode", "value") for r in ("A", "N", "R")}


@query("cellcount", f"with {NAMED} select feature_id, barcode, rep_id, value from u")
def concat_outer(cellcount):
    return features.outer(_named(cellcount)).select("feature_id", "barcode", "rep_id", "value")


@query("cellcount", f"with {NAMED}, f as (select feature_id from u group by 1 having count(distinct rep_id) = 3) select feature_id, barcode, rep_id, value from u where feature_id in (select feature_id from f)")
def concat_inner(cellcount):
    return features.inner(_named(cellcount)).select("feature_id", "barcode", "rep_id", "value")


@query("cellcount gene", "with m as (select 'B' || (start % 300)::varchar as src, max_by(brand, (start, gene_id)) as tgt from gene group by 1) select m.tgt as barcode, c.feature_id, sum(c.value)::bigint as value from cellcount c join m on c.barcode = m.src group by 1, 2")
def barcode_remap(cellcount, gene):
    mapping = gene.select(F.concat(F.lit("B"), (F.col("start") % 300).cast("string")).alias("src"), F.col("brand").alias("tgt"), F.struct("start", "gene_id").alias("row_id"))
    return features.remapped(cellcount, mapping).groupBy("barcode", "feature_id").agg(F.sum("value").alias("value"))


@query("cellcount", "select barcode, feature_id, rep_id, value from cellcount where barcode in (select 'B' || i::varchar from range(0, 50) t(i))")
def barcode_semi(cellcount):
    listed = cellcount.where(F.substring("barcode", 2, 9).cast("int") < 50).select("barcode")
    return features.restricted(cellcount, listed).select("barcode", "feature_id", "rep_id", "value")


@query("cellcount", "select barcode, feature_id, rep_id, value, case rep_id when 'A' then 0 when 'N' then 1 else 2 end as rep_index from cellcount")
def replicate_index(cellcount):
    reps = cellcount.sparkSession.createDataFrame([("A", 0), ("N", 1), ("R", 2)], "rep_id string, rep_index int")
    return features.replicate_index(cellcount, reps).select("barcode", "feature_id", "rep_id", "value", "rep_index")


@query("cellcount", "select barcode, sum(value)::bigint as value, row_number() over (order by barcode desc) - 1 as place from cellcount group by 1")
def listed_barcodes(cellcount):
    total = cellcount.groupBy("barcode").agg(F.sum("value").alias("value"))
    # numbered within first digits, the largest first, and on over them
    order = intervals.numbered_on(total.select("barcode", (-F.substring("barcode", 2, 1).cast("int")).alias("first")), "first", [F.desc("barcode")], "row_id").drop("first")
    return features.listed(total.join(order.withColumnRenamed("row_id", "place"), "barcode"), order).select("barcode", "value", "place")


@query("cellcount", "select 'B' || i::varchar as barcode from range(0, 600) t(i) where 'B' || i::varchar not in (select barcode from cellcount)")
def missing_barcodes(cellcount):
    wanted = cellcount.sparkSession.range(600).select(F.concat(F.lit("B"), F.col("id").cast("string")).alias("barcode"))
    return features.missing_barcodes(cellcount, wanted)


@query("gene region", """with o as (select g.gene_id, r.region_id, least(g.stop, r.stop) - greatest(g.start, r.start) as ov, r.start from gene g join region r on g.chrom = r.chrom and g.start < r.stop and r.start < g.stop),
    b as (select gene_id, region_id from (select *, row_number() over (partition by gene_id order by ov desc, start) as r from o) where r = 1) select r.region_id as bin_id, count(b.gene_id) as n_features from region r left join b using (region_id) group by 1""")
def features_by_block(gene, region):
    blocks = region.withColumnRenamed("region_id", "bin_id")
    placed = features.blocks(gene.withColumn("feature_id", F.col("gene_id")), blocks, bucket=1 << 22)
    return features.counted_by_block(placed, blocks).select("bin_id", "n_features")


@query("snp", "select chrom, pos0, ad::varchar as ad, 'true' as somatic, dp::varchar as dp from snp")
def info_map(snp):
    info = F.concat(F.lit("AD="), F.col("ad").cast("string"), F.lit(";SOMATIC;DP="), F.col("dp").cast("string"))
    m = C.info_map(info)
    return snp.select("chrom", "pos0", m["AD"].alias("ad"), m["SOMATIC"].alias("somatic"), m["DP"].alias("dp"))


@query("variant", "select chrom, pos0, gt, (pos0 % 97)::varchar as ps from variant")
def format_map(variant):
    m = C.format_map(F.lit("GT:PS"), F.concat_ws(":", "gt", (F.col("pos0") % 97).cast("string")))
    return variant.select("chrom", "pos0", m["GT"].alias("gt"), m["PS"].alias("ps"))


@query("gene", """with l as (select gene_id, case when start % 5 = 0 then null when start % 5 = 1 then 'T1' when start % 5 = 2 then 'T2_' || brand || '_x' else brand end as raw from gene)
    select gene_id, case when raw is null then 'normal' when raw like 'T%' and raw not like '%\\_%' escape '\\' then 'tumor' when raw like 'T%' then substr(raw, strpos(raw, '_') + 1) else raw end as label from l""")
def label_simplify(gene):
    k = F.col("start") % 5
    raw = F.when(k == 0, F.lit(None)).when(k == 1, "T1").when(k == 2, F.concat(F.lit("T2_"), F.col("brand"), F.lit("_x"))).otherwise(F.col("brand"))
    return gene.select("gene_id", C.simplify_label(raw).alias("label"))


# ---- bins and phase ------------------------------------------------------------------------------------


@query("snp region gene", """with s as (select s.chrom, s.chrom_ord, s.pos0, r.region_id from snp s join region r on r.chrom = s.chrom and s.pos0 >= r.start and s.pos0 < r.stop),
    n as (select *, row_number() over (partition by region_id order by pos0) - 1 as rn, count(*) over (partition by region_id) as c from s),
    l as (select *, least(rn // 7, greatest(c // 7 - 1, 0)) as lb from n), g as (select region_id, max(lb) + 1 as k, min((chrom_ord, pos0)) as f from l group by 1),
    o as (select region_id, coalesce(sum(k) over (order by f rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from g)
    select ahead + lb as bin_id, min_by(chrom, pos0) as chrom, min(pos0) as start, max(pos0) + 1 as stop, count(*) as n_rows, max(pos0) + 1 - min(pos0) as blocksize from l join o using (region_id) group by 1""")
def multi_snp_bins(snp, region, gene):
    s = intervals.points_in_intervals(snp, region, ["region_id"], bucket=1 << 22).withColumn("start", F.col("pos0")).withColumn("stop", F.col("pos0") + 1)
    d = binning.numbered(binning.by_number(s, ["region_id"], ["pos0"], 7), ["region_id"], ["chrom_ord", "pos0"])
    return binning.bin_bounds(d, "pos0").select("bin_id", "chrom", "start", "stop", "n_rows", "blocksize")


@query("gene", """with f as (select chrom, gene_id, start, brand, row_number() over (partition by chrom, brand order by start, gene_id) as r from gene)
    select chrom, string_agg(brand, ';' order by start, gene_id) as brand from f where r = 1 group by chrom""")
def first_seen_names(gene):
    d = gene.withColumn("bin_id", F.col("chrom")).withColumn("at", F.struct("start", "gene_id"))
    return binning.bin_bounds(d, "at", names="brand").select(F.col("bin_id").alias("chrom"), "brand")


FOLD = """recursive with r as (select chrom, chrom_ord, pos0, {reads} as reads, row_number() over (partition by chrom order by pos0) as i, count(*) over (partition by chrom) as n from {src}),
    w as (select chrom, i, pos0, n, reads as acc, 1 as k, 0::bigint as b, pos0 as s, {stop} as e from r where i = 1
      union all select r.chrom, r.i, r.pos0, r.n, case when {full} then r.reads else w.acc + r.reads end, case when {full} then 1 else w.k + 1 end, case when {full} then w.b + 1 else w.b end,
        case when {full} then r.pos0 else w.s end, {rstop} from w join r on r.chrom = w.chrom and r.i = w.i + 1),
    z as (select chrom, b, case when {lastfull} and b > 0 then b else greatest(b - 1, 0) end as fin from w where i = n),"""


@query("snp", FOLD.format(reads="dp", src="snp", stop="pos0 + 1", rstop="r.pos0 + 1", full="(w.acc >= 1000 and w.k >= 10)", lastfull="(acc >= 1000 and k >= 10)").rstrip(",") + """
    select w.chrom, w.pos0, least(w.b, z.fin) as local_bin from w join z using (chrom)""")
def adaptive_bins(snp):
    d = snp.select("chrom", "pos0", "dp").withColumns({"n_snps": F.lit(1).cast("long"), "start": F.col("pos0"), "stop": F.col("pos0") + 1})
    return binning.by_reads(d, ["chrom"], ["pos0"], ["dp"], 1000, 10).select("chrom", "pos0", "local_bin")


@query("snp win", """recursive with v as (select w.chrom, w.start as pos0, w.stop, count(s.pos0) as ns, coalesce(sum(s.dp), 0)::bigint as reads from win w left join snp s on s.chrom = w.chrom and s.pos0 >= w.start and s.pos0 < w.stop group by 1, 2, 3),
    r as (select *, row_number() over (partition by chrom order by pos0) as i, count(*) over (partition by chrom) as n from v),
    w as (select chrom, i, pos0, n, reads as acc, ns as k, 0::bigint as b, pos0 as s, stop as e from r where i = 1
      union all select r.chrom, r.i, r.pos0, r.n, case when (w.acc >= 1000 and w.k >= 40) or w.e - w.s >= 48000 then r.reads else w.acc + r.reads end, case when (w.acc >= 1000 and w.k >= 40) or w.e - w.s >= 48000 then r.ns else w.k + r.ns end,
        case when (w.acc >= 1000 and w.k >= 40) or w.e - w.s >= 48000 then w.b + 1 else w.b end, case when (w.acc >= 1000 and w.k >= 40) or w.e - w.s >= 48000 then r.pos0 else w.s end, r.stop from w join r on r.chrom = w.chrom and r.i = w.i + 1),
    z as (select chrom, case when ((acc >= 1000 and k >= 40) or e - s >= 48000) and b > 0 then b else greatest(b - 1, 0) end as fin from w where i = n)
    select w.chrom, w.pos0 as start, least(w.b, z.fin) as local_bin from w join z using (chrom)""")
def adaptive_window_bins(snp, win):
    per = intervals.points_in_intervals(snp, win, ["start"], bucket=BUCKET).groupBy("chrom", "start").agg(F.count("*").alias("n_snps"), F.sum("dp").alias("dp"))
    w = win.select("chrom", "start", "stop").join(per, ["chrom", "start"], "left").fillna(0, ["n_snps", "dp"])
    return binning.by_reads(w, ["chrom"], ["start"], ["dp"], 1000, 40, 48_000).select("chrom", "start", "local_bin")


def _tail(x: float, fewer: str, n: str) -> str:
    return f"coalesce(list_sum(list_transform(range(0, ({fewer})::bigint), lambda j: exp(lgamma({n} + 1) - lgamma(j + 1) - lgamma({n} + 1 - j) + j * ln({x}::double) + ({n} - j) * ln({1 - x}::double)))), 0)"


FLIPS = f"""with p as (select *, case when phase = 1 then dp - ad else ad end as b from snp),
    q as (select *, 1 - {_tail(0.45, 'b + 1', '(dp + 1)')} > 0.975 as lo, 1 - {_tail(0.55, 'b + 1', '(dp + 1)')} < 0.025 as hi from p),
    f as (select *, coalesce((lag(lo) over w and hi) or (lag(hi) over w and lo), false) as flip from q window w as (partition by chrom order by pos0))"""


@query("snp", FLIPS + """, l as (select *, sum(flip::int) over (partition by chrom order by pos0)::bigint as lb from f), g as (select chrom, max(lb) + 1 as k, min((chrom_ord, pos0)) as o from l group by 1),
    a as (select chrom, coalesce(sum(k) over (order by o rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from g) select chrom, pos0, flip, ahead + lb as phase_group from l join a using (chrom)""")
def phase_flips(snp):
    d = binning.flips(counts.phased(snp), ["chrom"], ["pos0"], {"t": ("b", "a")})
    return binning.phase_groups(d, ["chrom"], ["chrom_ord", "pos0"]).select("chrom", "pos0", "flip", "phase_group")


@query("snp", FLIPS.replace("coalesce((lag", "abs(b::double / dp - lag(b::double / dp) over w) as gap, coalesce((lag") + " select chrom, pos0, gap from f where flip order by gap desc, chrom, pos0 limit 10")
def top_flips(snp):
    from pyspark.sql import Window as W

    d = counts.phased(snp).withColumn("gap", F.abs(C.ratio(F.col("b"), F.col("dp")) - F.lag(C.ratio(F.col("b"), F.col("dp"))).over(W.partitionBy("chrom").orderBy("pos0"))))
    return binning.flips(d, ["chrom"], ["pos0"], {"t": ("b", "a")}).where("flip").orderBy(F.desc("gap"), "chrom", "pos0").limit(10).select("chrom", "pos0", "gap")


@query("snp", FLIPS.replace("coalesce((lag", "abs(b::double / dp - lag(b::double / dp) over w) as gap, coalesce((lag") + " select chrom, pos0, gap from f where flip order by gap, chrom, pos0 limit 10")
def bottom_flips(snp):
    from pyspark.sql import Window as W

    d = counts.phased(snp).withColumn("gap", F.abs(C.ratio(F.col("b"), F.col("dp")) - F.lag(C.ratio(F.col("b"), F.col("dp"))).over(W.partitionBy("chrom").orderBy("pos0"))))
    return binning.flips(d, ["chrom"], ["pos0"], {"t": ("b", "a")}).where("flip").orderBy("gap", "chrom", "pos0").limit(10).select("chrom", "pos0", "gap")


@query("snp win", """with s as (select s.chrom, w.start, s.dp % 5 as ps, count(*) as c from snp s join win w on s.chrom = w.chrom and s.pos0 >= w.start and s.pos0 < w.stop where s.pos0 % 4 = 0 group by 1, 2, 3),
    m as (select chrom, start, ps from (select *, row_number() over (partition by chrom, start order by c desc, ps) as r from s) where r = 1), j as (select w.chrom, w.chrom_ord, w.start, m.ps from win w left join m using (chrom, start))
    select chrom, start, last_value(ps ignore nulls) over (order by chrom_ord, start rows unbounded preceding) as ps from j""")
def window_phase_mode_ffill(snp, win):
    # all SNPs are read; three in four have no phase set
    ps = F.when(F.col("pos0") % 4 == 0, F.col("dp") % 5)
    hit = intervals.points_in_intervals(snp.withColumn("ps", ps), win, ["start"], bucket=BUCKET)
    w = win.select("chrom", "chrom_ord", "start").join(binning.mode_by_window(hit, ["chrom", "start"], "ps"), ["chrom", "start"], "left")
    return binning.filled_forward(w, ["ps"], "chrom_ord", ["start"]).select("chrom", "start", "ps")


# ---- depth ---------------------------------------------------------------------------------------------


@query("depth", "select coalesce(chrom, 'TOTAL') as chrom, sample_id, round(avg(depth), 9) as mean_depth, median(depth) as median_depth from depth group by grouping sets ((sample_id, chrom), (sample_id))")
def depth_statistics(depth_):
    return depth.statistics(depth_).withColumn("mean_depth", F.round("mean_depth", 9))


@query("depth win", "select d.chrom, d.start, d.stop, d.sample_id, d.depth, case when start % 3 = 0 then w.gc end as gc, case when start % 3 < 2 then w.map end as map from depth d left join win w using (chrom, start, stop)")
def window_merge(depth_, win):
    # all windows meet their depths; a third of them have a gc, two thirds a mappability
    some = win.select("chrom", "start", "stop", F.when(F.col("start") % 3 == 0, F.col("gc")).alias("gc"), F.when(F.col("start") % 3 < 2, F.col("map")).alias("map"))
    return depth.with_windows(depth_.select("chrom", "start", "stop", "sample_id", "depth"), some).select("chrom", "start", "stop", "sample_id", "depth", "gc", "map")


@query("depth", "select sample_id, round(sqrt(avg(pow(depth - gc * 100, 2))), 6) as rmse from depth where depth > 0 and gc is not null group by 1")
def fit_rmse(depth_):
    return depth.rmse(depth_.withColumn("p", F.col("gc") * 100), "depth", "p").withColumn("rmse", F.round("rmse", 6))


BINS = "b as (select chrom, start // 40000 as bin_id, sample_id, sum(depth * (stop - start)) / sum(stop - start) as depth from depth group by 1, 2, 3)"


def _bins(d):
    return depth.weighted(d.withColumn("bin_id", F.floor(F.col("start") / 40000)), ["chrom", "bin_id", "sample_id"])


@query("depth", f"with {BINS} select chrom, bin_id, sample_id, round(depth, 9) as depth from b")
def weighted_depth(depth_):
    return _bins(depth_).withColumn("depth", F.round("depth", 9))


@query("depth", f"""with {BINS}, t as (select sample_id, sum(depth * (stop - start)) as total from depth group by 1)
    select b.chrom, b.bin_id, b.sample_id, round(case when n.depth > 0 then b.depth / n.depth * ((select total from t where sample_id = 'N') / t.total) when n.depth = 0 and b.depth > 0 then 'inf'::double end, 9) as rdr
    from b left join b n on n.chrom = b.chrom and n.bin_id = b.bin_id and n.sample_id = 'N' join t on t.sample_id = b.sample_id where b.sample_id <> 'N'""")
def rdr_normal(depth_):
    b = _bins(depth_).withColumn("key", F.struct("chrom", "bin_id"))
    return depth.ratio_to_normal(b, depth_, "N", "key").select("chrom", "bin_id", "sample_id", F.round("rdr", 9).alias("rdr"))


# a window in seven is not read at all, and so are bins of such windows alone
SPARSE = BINS.replace("from depth", "from (select * replace (case when start // 4000 % 7 = 3 or start // 40000 % 5 = 2 then 0 else depth end as depth) from depth)")


@query("depth", f"with {SPARSE}, m as (select sample_id, median(depth) as m from b where depth > 0 group by 1) select chrom, bin_id, sample_id, round(case when depth > 0 then depth / m end, 9) as rdr from b left join m using (sample_id)")
def rdr_median(depth_):
    unread = (F.floor(F.col("start") / 4000) % 7 == 3) | (F.floor(F.col("start") / 40000) % 5 == 2)
    return depth.ratio_to_median(_bins(depth_.withColumn("depth", F.when(unread, 0.0).otherwise(F.col("depth"))))).select("chrom", "bin_id", "sample_id", F.round("rdr", 9).alias("rdr"))


@query("depth", f"with {BINS} select chrom, bin_id, sample_id, round(case when depth <= (select quantile_cont(depth, 0.95::double) from b) then depth end, 9) as depth from b")
def rdr_outlier(depth_):
    return depth.without_outliers(_bins(depth_), 0.05, "depth").withColumn("depth", F.round("depth", 9)).select("chrom", "bin_id", "sample_id", "depth")


@query("depth", f"""with {BINS}, c as (select *, case when depth <= 110 then depth end as v from b), g as (select chrom, bin_id from c group by 1, 2 having bool_and(v is not null)),
    k as (select *, (row_number() over (order by chrom, bin_id) - 1)::bigint as new_id from g) select chrom, bin_id, sample_id, new_id from c join k using (chrom, bin_id)""")
def nan_row_filter(depth_):
    b = _bins(depth_).withColumn("v", F.when(F.col("depth") <= 110, F.col("depth")))
    return depth.complete_rows(b, ["chrom", "bin_id"], ["v"], ["chrom", "bin_id"]).select("chrom", "bin_id", "sample_id", "new_id")


@query("depth", """with r as (select *, rank() over (partition by sample_id order by depth) + (count(*) over (partition by sample_id, depth) - 1) / 2.0::double as rd, rank() over (partition by sample_id order by gc) + (count(*) over (partition by sample_id, gc) - 1) / 2.0::double as rg from depth),
    c as (select sample_id, corr(gc, depth) as p, corr(rg, rd) as s from r group by 1), m as (select sample_id, greatest(0, least(99, floor(gc * 100))) as g, median(depth) as m from depth group by 1, 2)
    select sample_id, round(any_value(p), 6) as pearson, round(any_value(s), 6) as spearman, round(stddev_pop(m), 6) as bin_std from c join m using (sample_id) group by 1""")
def gc_depth_stats(depth_):
    return depth.gc_statistics(depth_).select("sample_id", *[F.round(c, 6).alias(c) for c in ("pearson", "spearman", "bin_std")])


@query("depth", """with t as (select sample_id, quantile_cont(depth, 0.99::double) as top from depth group by 1)
    select sample_id, least(floor(depth / (top / 50)), 49)::int as bin, count(*) as n from depth join t using (sample_id) where depth <= top group by 1, 2""")
def depth_hist(depth_):
    return depth.depth_histogram(depth_)


@query("snp_sample", "select sample_id, least(floor((ad::double / dp) / (1::double / 50)), 49)::int as bin, count(*) as n from snp_sample where dp > 0 group by 1, 2")
def af_hist(snp_sample):
    return depth.histogram(snp_sample.withColumn("af", C.ratio(F.col("ad"), F.col("dp"))), "af", 50, 0.0, 1.0)


@query("depth", "select sample_id, round(quantile_cont(gc, 0.001::double), 9) as low, round(quantile_cont(gc, 0.999::double), 9) as high from depth group by 1")
def covariate_domain(depth_):
    return depth.domain(depth_, "gc").select("sample_id", F.round("low", 9).alias("low"), F.round("high", 9).alias("high"))


@query("depth", """with r as (select *, rank() over (partition by sample_id order by depth) + (count(*) over (partition by sample_id, depth) - 1) / 2.0::double as rd, rank() over (partition by sample_id order by repli) + (count(*) over (partition by sample_id, repli) - 1) / 2.0::double as rg, abs(depth - median(depth) over (partition by sample_id)) as far from depth)
    select sample_id, median(far) as mad, round(corr(repli, depth), 6) as pearson, round(corr(rg, rd), 6) as spearman from r group by 1""")
def panel_statistics(depth_):
    return depth.panel_statistics(depth_, "repli", "depth").select("sample_id", "mad", F.round("pearson", 6).alias("pearson"), F.round("spearman", 6).alias("spearman"))


@query("depth", "with m as (select sample_id, median(depth) as middle from depth group by 1) select sample_id, middle, median(abs(depth - middle)) as mad from depth join m using (sample_id) group by 1, 2")
def mad_corr(depth_):
    return depth.spread(depth_)


@query("depth", "select sample_id, round(quantile_cont(depth, 0.99::double), 9) as \"limit\" from depth group by 1")
def value_limits(depth_):
    return depth.limits(depth_, "depth").withColumn("limit", F.round("limit", 9))


@query("snp size", "with s as (select chrom, coalesce(sum(size) over (order by chrom_ord rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from size) select chrom, pos0, pos0 + ahead as x from snp join s using (chrom)")
def genome_coords(snp, size):
    return features.coordinates(snp, size).select("chrom", "pos0", "x")


@query("blacklist", "select chrom, string_agg(start::varchar || '-' || stop::varchar, ',' order by start, stop) as spans from blacklist group by 1")
def interval_shading(blacklist):
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",")
    return features.shades(blacklist).select("chrom", text.alias("spans"))


@query("depth", "select chrom, least(10::double, greatest(0.5::double, 20000::double / count(*))) as size from depth group by chrom")
def dot_sizes(depth_):
    return depth_.groupBy("chrom").agg(F.count("*").alias("n")).select("chrom", C.dot_size(F.col("n")).alias("size"))


@query("depth")
def quadreg_correct(depth_):
    return depth.corrected_by_regression(depth_).select("chrom", "start", "sample_id", "depth", "corrected")


@query("depth")
def lowess_correct(depth_):
    return depth.corrected_by_lowess(depth_).select("chrom", "start", "sample_id", "depth", "corrected")


@query("depth")
def density_grid(depth_):
    return depth.density(depth_, "gc", "depth", size=50)


# ---- phasing by reads ----------------------------------------------------------------------------------


# an order's lines on a chromosome are a read over their places; its alleles follow planted haplotypes
@query("obs", """recursive with o as (select distinct k1, chrom, pos0 from obs), l as (select distinct chrom, lag(pos0) over (partition by k1, chrom order by pos0) as u, pos0 as v from o),
    b as (select chrom, u, v from l where u is not null union select chrom, v, u from l where u is not null),
    reach as (select chrom, u as pos0, u as r from b union select b.chrom, b.v, reach.r from reach join b on b.chrom = reach.chrom and b.u = reach.pos0 where reach.r < b.v),
    c as (select chrom, pos0, min(r) as ps from reach group by 1, 2)
    select chrom, pos0, ps + 1 as ps, ((pos0 // 7 + ps // 7) % 2)::int as phase from c""")
def read_backed_phase(obs):
    allele = (F.floor(F.col("pos0") / 7) + F.col("k1")) % 2
    return phasing.phased(obs.select(F.col("k1").alias("read_id"), "chrom", "pos0", allele.cast("int").alias("allele")))


# ---- alignments ----------------------------------------------------------------------------------------


def _aligned(alignment, size):
    """The alignments as indexed binary files, with barcode and sample as tags, read back by what is returned; and how the files lay out positions."""
    path = scratch(alignment.sparkSession, "bam")
    tags = F.filter(F.array(F.concat(F.lit("CB:Z:"), "barcode"), F.concat(F.lit("RG:Z:"), "sample_id"), F.concat(F.lit("NM:i:"), F.col("kind").cast("string"))), lambda t: t.isNotNull())
    empty = {c: F.lit(None) for c in ("next_chrom", "next_pos0", "length")}
    held = bam.write(alignment.withColumns({"tags": tags, **empty}), size, path)
    return bam.read(alignment.sparkSession, path), held


def _fields(reads):
    return reads.select("name", "flag", "chrom", "pos0", "mapq", "cigar", "seq", "qual", alignments.tag("CB").alias("barcode"), alignments.tag("RG").alias("sample_id"))


@query("alignment size", "select name, flag, chrom, pos0, mapq, cigar, seq, qual, barcode, sample_id from alignment")
def read_alignments(alignment, size):
    return _fields(_aligned(alignment, size)[0])


@query("alignment size", "select name, flag, chrom, pos0, mapq, cigar, seq, qual, barcode, sample_id from alignment where chrom in ('chr3', 'chr14') and pos0 between 20000 and 700000")
def alignments_in_range(alignment, size):
    return _fields(_aligned(alignment, size)[0].where("chrom in ('chr3', 'chr14') and pos0 between 20000 and 700000"))


TARGETS = """t as (select 'B' || (start % 300)::varchar as src, max_by(brand, struct_pack(start := start, gene_id := gene_id)) as tgt from gene group by 1)"""


def _targets(gene):
    return gene.select(F.concat(F.lit("B"), (F.col("start") % 300).cast("string")).alias("src"), F.col("brand").alias("tgt"), F.struct("start", "gene_id").alias("row_id"))


@query("alignment size gene", f"with {TARGETS} select name, flag, chrom, pos0, seq, tgt as barcode, sample_id from alignment join t on barcode = src")
def rebarcoded_alignments(alignment, size, gene):
    """Read, given the barcodes of their targets, written and read again."""
    reads, held = _aligned(alignment, size)
    new = stored(alignments.rebarcoded(reads, _targets(gene)), "rebarcoded")  # which the writer goes through twice
    path = scratch(new.sparkSession, "bam")
    bam.write(new, size, path, held=held)
    dropped(new)
    return _fields(bam.read(new.sparkSession, path)).select("name", "flag", "chrom", "pos0", "seq", "barcode", "sample_id")


@query("alignment gene", f"""with {TARGETS} select count(*) as processed, count(*) filter (barcode is null) as missing, count(*) filter (barcode is not null and tgt is null) as unlisted,
    count(*) filter (tgt is not null) as kept from alignment left join t on barcode = src""")
def barcode_accounting(alignment, gene):
    return alignments.barcode_accounting(alignment.withColumn("tags", F.filter(F.array(F.concat(F.lit("CB:Z:"), "barcode")), lambda t: t.isNotNull())), _targets(gene))


SEEN = """h as (select s.chrom, s.pos0, s.ref, s.alt, a.name, a.sample_id, a.seq, a.qual, a.kind, s.pos0 - a.pos0 as d from site s join alignment a on a.chrom = s.chrom and s.pos0 >= a.pos0 and s.pos0 < a.pos0 + 22 where a.flag <> 1024 and a.mapq >= 5),
    i as (select *, case kind when 0 then case when d < 20 then d end when 1 then case when d < 17 then d + 3 end when 2 then case when d < 6 then d when d >= 8 then d - 2 end else case when d < 8 then d when d < 17 then d + 3 end end as u from h),
    q as (select *, substr(seq, u + 1, 1) as base, ascii(substr(qual, u + 1, 1)) - 33 as quality from i where u is not null),
    b as (select chrom, pos0, ref, alt, name, sample_id, base, quality from (select *, row_number() over (partition by chrom, pos0, ref, alt, name, sample_id order by quality desc, base) as r from q where quality >= 13) where r = 1)"""


def _seen(alignment, site):
    return alignments.bases_at(alignment, site, ["sample_id"], min_mapq=5, min_quality=13)


@query("alignment site", f"with {SEEN} select * from b")
def site_bases(alignment, site):
    return _seen(alignment, site)


SCORED = """e as (select *, pow(10.0::double, -least(greatest(quality, 1), 60) / 10.0::double) as w from b),
    s as (select chrom, pos0, ref, alt, sample_id, count(*) filter (base in (ref, alt)) as dp, count(*) filter (base = alt) as ad, count(*) filter (base not in (ref, alt)) as oth,
      coalesce(sum(round(log10(case when base = ref then 1 - w else w end) * 1000000)::bigint) filter (base in (ref, alt)), 0)::bigint as l0,
      coalesce(sum(round(log10(0.5::double) * 1000000)::bigint) filter (base in (ref, alt)), 0)::bigint as l1,
      coalesce(sum(round(log10(case when base = ref then w else 1 - w end) * 1000000)::bigint) filter (base in (ref, alt)), 0)::bigint as l2 from e group by chrom, pos0, ref, alt, sample_id)"""


@query("alignment site", f"with {SEEN}, {SCORED} select * from s")
def genotype_likelihoods(alignment, site):
    return alignments.likelihoods(_seen(alignment, site), ["sample_id"])


@query("alignment site", f"""recursive with {SEEN}, {SCORED},
    x as (select *, greatest(l0, l1, l2) as m, pow(10.0::double, (l0 - m) / 1000000.0::double) as w0, pow(10.0::double, (l1 - m) / 1000000.0::double) as w1, pow(10.0::double, (l2 - m) / 1000000.0::double) as w2 from s),
    v as (select chrom, pos0, ref, alt, list(struct_pack(a := w0, b := w1, c := w2)) as ws from x group by all),
    em as (select chrom, pos0, ref, alt, ws, 0.5::double as f, 0 as n from v union all
      select chrom, pos0, ref, alt, ws, least(greatest(list_sum(list_transform(ws, lambda g: (2 * f * (1 - f) * g.b + 2 * f * f * g.c) / (2 * ((1 - f) * (1 - f) * g.a + 2 * f * (1 - f) * g.b + f * f * g.c)))) / len(ws), 0.0001::double), 1 - 0.0001::double), n + 1 from em where n < 20),
    y as (select x.*, f, (1 - f) * (1 - f) * w0 as p0, 2 * f * (1 - f) * w1 as p1, f * f * w2 as p2, p0 + p1 + p2 as t from x join em using (chrom, pos0, ref, alt) where n = 20)
    select chrom, pos0, sample_id, round(f, 5) as af, round(least(-10 * sum(log10(greatest(p0 / t, 1e-300::double))) over (partition by chrom, pos0, ref, alt), 999), 2) + 0.0::double as qual,
      case when dp = 0 then './.' when p0 >= p1 and p0 >= p2 then '0/0' when p1 >= p2 then '0/1' else '1/1' end as gt,
      round(least(-10 * log10(greatest(case when p0 >= p1 and p0 >= p2 then p1 + p2 when p1 >= p2 then p0 + p2 else p0 + p1 end / t, 1e-300::double)), 999), 2) + 0.0::double as gq,
      round((m - l0) / 100000.0::double)::int as pl0, round((m - l1) / 100000.0::double)::int as pl1, round((m - l2) / 100000.0::double)::int as pl2 from y""")
def genotypes_by_reads(alignment, site):
    d = alignments.genotyped(alignments.likelihoods(_seen(alignment, site), ["sample_id"]))
    return d.select("chrom", "pos0", "sample_id", F.round("af", 5).alias("af"), "qual", "gt", "gq", *[F.col("pl")[k].alias(f"pl{k}") for k in range(3)])


# ---- other assemblies ----------------------------------------------------------------------------------

# a chain for each chromosome, two blocks for each part; those of even chromosomes run on the other strand
CHAINED = """c as (select 'chr' || (p_partkey % 22 + 1)::varchar as chrom, p_partkey % 22 + 1 as chain_id, p_partkey * 500 as t, p_partkey * 400 as q, p_size from part),
    b0 as (select chrom, chain_id, t as start, t + 100 as stop, q as qa, q + 100 as qz from c union all select chrom, chain_id, t + 110, t + 200 + p_size * 5, q + 104, q + 194 + p_size * 5 from c),
    blocks as (select *, case when chain_id % 2 = 1 then '+' else '-' end as strand, case when chain_id % 2 = 1 then qa else 1000000000 - qz end as to_start, case when chain_id % 2 = 1 then qz else 1000000000 - qa end as to_stop from b0),
    iv as (select chrom, t + p_size * 4 as start, t + p_size * 12 as stop from c),
    h as (select iv.chrom, iv.start, iv.stop, b.chain_id, b.strand, greatest(iv.start, b.start) as a, least(iv.stop, b.stop) as z, case when b.strand = '+' then b.to_start + greatest(iv.start, b.start) - b.start else b.to_start + b.stop - least(iv.stop, b.stop) end as ta
      from iv join blocks b on b.chrom = iv.chrom and b.start < iv.stop and iv.start < b.stop)"""


def _chained(part):
    """The chain file of those blocks, read back, and the intervals to lift."""
    c = part.select((F.col("p_partkey") % 22 + 1).alias("id"), F.struct((F.col("p_partkey") * 500).alias("t"), (F.col("p_partkey") * 400).alias("q"), (F.lit(90) + F.col("p_size") * 5).alias("s")).alias("x"))
    g = c.groupBy("id").agg(F.array_sort(F.collect_list("x")).alias("x")).withColumn("n", F.size("x"))
    first, last = F.element_at("x", 1), F.element_at("x", -1)
    line = lambda x, k: F.concat(F.lit("100 10 4\n"), x["s"].cast("string"), F.when(k + 1 < F.col("n"), F.concat_ws(" ", F.lit(""), (F.get("x", k + 1)["t"] - x["t"] - 110 - x["s"]).cast("string"), (F.get("x", k + 1)["q"] - x["q"] - 104 - x["s"]).cast("string"))).otherwise(""))
    head = F.concat_ws(" ", F.lit("chain 99"), F.concat(F.lit("chr"), "id"), F.lit("2000000000 +"), first["t"], last["t"] + 110 + last["s"], F.concat(F.lit("alt"), "id"), F.lit("1000000000"), F.when(F.col("id") % 2 == 1, "+").otherwise("-"), first["q"], last["q"] + 104 + last["s"], "id")
    text = g.select(F.concat(head, F.lit("\n"), F.array_join(F.transform("x", line), "\n"), F.lit("\n")).alias("value"))
    path = scratch(part.sparkSession, "chain")
    text.write.text(path)
    chrom = F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string"))
    return readers.chains(part.sparkSession, path), part.select(chrom.alias("chrom"), (F.col("p_partkey") * 500 + F.col("p_size") * 4).alias("start"), (F.col("p_partkey") * 500 + F.col("p_size") * 12).alias("stop"))


@query("parts", f"with {CHAINED} select chain_id, chrom, start, stop, 'alt' || chain_id::varchar as to_chrom, to_start, to_stop, strand from blocks")
def read_chains(part):
    return _chained(part)[0].drop("score")


@query("parts", f"""with {CHAINED}, p as (select chrom, start, stop, any_value(strand) as s, sum(z - a)::bigint as mapped, min(ta) as ta, max(ta + z - a) as tz, any_value(chain_id) as id from h group by 1, 2, 3)
    select iv.*, case when mapped >= 0.95::double * (iv.stop - iv.start) then 'alt' || id::varchar end as to_chrom, case when mapped >= 0.95::double * (iv.stop - iv.start) then ta end as to_start, case when mapped >= 0.95::double * (iv.stop - iv.start) then tz end as to_stop,
      case when mapped >= 0.95::double * (iv.stop - iv.start) then s end as strand, coalesce(mapped, 0) as mapped, case when mapped is null then 'deleted' when mapped >= 0.95::double * (iv.stop - iv.start) then 'lifted' else 'partial' end as status
    from iv left join p using (chrom, start, stop)""")
def lifted_intervals(part):
    blocks, iv = _chained(part)
    return lift.lifted(iv, blocks, bucket=BUCKET)


@query("parts", f"with {CHAINED} select chrom, start as from_start, stop as from_stop, chain_id, a as start, z as stop, 'alt' || chain_id::varchar as to_chrom, ta as to_start, ta + z - a as to_stop, strand from h")
def lifted_pieces(part):
    blocks, iv = _chained(part)
    return lift.pieces(iv, blocks, ["chrom", "start", "stop"], BUCKET).withColumnsRenamed({"_from": "from_start", "_upto": "from_stop"})


# ---- genetic maps --------------------------------------------------------------------------------------

CM = """i as (select p.chrom, p.pos, (select max(pos) from knot k where k.chrom = p.chrom and k.pos <= p.pos) as lo, (select min(pos) from knot k where k.chrom = p.chrom and k.pos > p.pos) as hi from p),
    cm as (select i.chrom, i.pos, case when lo is null then h.cm when hi is null then l.cm else l.cm + (h.cm - l.cm) * (i.pos - lo) / (hi - lo) end as cm from i left join knot l on l.chrom = i.chrom and l.pos = i.lo left join knot h on h.chrom = i.chrom and h.pos = i.hi)"""


@query("snp knot", f"with p as (select chrom, pos0 as pos from snp), {CM} select chrom, pos as pos0, round(cm, 9) as cm from cm")
def cm_interp(snp, knot):
    return genetics.interpolated(snp, knot, bucket=1 << 17).select("chrom", "pos0", F.round("cm", 9).alias("cm"))


BLOCKS = "blk as (select chrom, pos0 // 30000 as bin_id, min(pos0) as first_pos, max(pos0) as last_pos, max(dp) % 3 as ps from snp group by 1, 2)"


@query("snp knot", f"""with {BLOCKS}, p as (select distinct chrom, first_pos as pos from blk union select distinct chrom, last_pos from blk), {CM},
    d as (select b.chrom, b.bin_id, s.cm as s, e.cm as e from blk b join cm s on s.chrom = b.chrom and s.pos = b.first_pos join cm e on e.chrom = b.chrom and e.pos = b.last_pos),
    g as (select *, greatest(0, coalesce(s - lag(e) over (partition by chrom order by bin_id), 0)) as distance from d)
    select chrom, bin_id, round(distance, 9) as distance, round(greatest(0.000001::double, (1 - exp(-2 * distance)) / 2), 9) as switchprob from g""")
def switchprob_cm(snp, knot):
    b = snp.groupBy("chrom", F.floor(F.col("pos0") / 30000).alias("bin_id")).agg(F.min("pos0").alias("first_pos"), F.max("pos0").alias("last_pos"))
    return genetics.switchprobs_from_map(b, knot, bucket=1 << 17).select("chrom", "bin_id", F.round("distance", 9).alias("distance"), F.round("switchprob", 9).alias("switchprob"))


@query("snp", f"with {BLOCKS} select chrom, bin_id, case when lag(ps) over (partition by chrom order by bin_id) = ps then 0.000001::double else 0.4999::double end as switchprob from blk")
def switchprob_ps(snp):
    b = snp.groupBy("chrom", F.floor(F.col("pos0") / 30000).alias("bin_id")).agg((F.max("dp") % 3).alias("ps"))
    return genetics.switchprobs_from_phase_sets(b, ["bin_id"]).select("chrom", "bin_id", "switchprob")


@query("knot", "select case when c in ('23', 'chr23') then 'chrX' when c like 'chr%' then c else 'chr' || c end as chrom, pos, cm from (select case when chrom = 'chr1' then '23' when chrom = 'chr2' then 'Un' else substr(chrom, 4) end as c, pos, cm from knot) where c <> 'Un'")
def genetic_map_rows(knot):
    c = F.when(F.col("chrom") == "chr1", "23").when(F.col("chrom") == "chr2", "Un").otherwise(F.substring("chrom", 4, 9))
    return readers.map_rows(knot.withColumn("chrom", c))


# ---- stages --------------------------------------------------------------------------------------------


@query("snp_sample region", f"""with t as (select chrom, chrom_ord, pos0, sum(dp)::bigint as dp, sum(ad)::bigint as ad from snp_sample group by 1, 2, 3), c as (select *, {GT} as gt from t), h as (select * from c where gt = '0/1'),
    s as (select h.chrom, h.chrom_ord, h.pos0, r.region_id from h join region r on r.chrom = h.chrom and h.pos0 >= r.start and h.pos0 < r.stop),
    n as (select *, row_number() over (partition by region_id order by pos0) - 1 as rn, count(*) over (partition by region_id) as c from s), l as (select *, least(rn // 20, greatest(c // 20 - 1, 0)) as lb from n),
    g as (select region_id, max(lb) + 1 as k, min((chrom_ord, pos0)) as f from l group by 1), o as (select region_id, coalesce(sum(k) over (order by f rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from g)
    select ahead + lb as bin_id, x.sample_id, sum(case when (x.pos0 // 500) % 2 = 1 then x.dp - x.ad else x.ad end)::bigint as b, sum(x.dp)::bigint as dp, sum(case when (x.pos0 // 500) % 2 = 1 then x.dp - x.ad else x.ad end)::double / sum(x.dp)::double as af
    from l join o using (region_id) join snp_sample x on x.chrom = l.chrom and x.pos0 = l.pos0 group by 1, 2""")
def bulk_baf(snp_sample, region):
    return stages.bulk_baf(snp_sample.withColumn("phase", F.floor(F.col("pos0") / 500) % 2), region, 20, 1 << 22)


SINGLE = f"""with t as (select chrom, chrom_ord, pos0, sum(dp)::bigint as dp, sum(ad)::bigint as ad from obs group by 1, 2, 3), c as (select *, {GT} as gt from t), h as (select * from c where gt = '0/1'),
    s as (select h.chrom, h.chrom_ord, h.pos0, r.region_id from h join region r on r.chrom = h.chrom and h.pos0 >= r.start and h.pos0 < r.stop),
    n as (select *, row_number() over (partition by region_id order by pos0) - 1 as rn, count(*) over (partition by region_id) as c from s), l as (select *, least(rn // 2, greatest(c // 2 - 1, 0)) as lb from n),
    g as (select region_id, max(lb) + 1 as k, min((chrom_ord, pos0)) as f from l group by 1), o as (select region_id, coalesce(sum(k) over (order by f rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from g),
    b as (select l.chrom, l.pos0, ahead + lb as bin_id from l join o using (region_id))"""


def _modalities(obs):
    cells = obs.withColumns({"barcode": F.concat(F.lit("B"), F.col("cell").cast("string")), "phase": F.floor(F.col("pos0") / 500) % 2})
    return {"dna": cells.where("modality = 'F'"), "rna": cells.where("modality = 'O'")}


@query("obs region gene exon", SINGLE + """
    select b.bin_id, 'B' || x.cell::varchar || case x.modality when 'F' then '_dna' else '_rna' end as barcode, sum(case when (x.pos0 // 500) % 2 = 1 then x.dp - x.ad else x.ad end)::bigint as b, sum(x.dp)::bigint as dp,
      sum(case when (x.pos0 // 500) % 2 = 1 then x.dp - x.ad else x.ad end)::double / sum(x.dp)::double as af from b join obs x using (chrom, pos0) group by 1, 2""")
def single_cell_counts(obs, region, gene, exon):
    return stages.single_cell(_modalities(obs), region, gene, exon, bucket=1 << 22)["cell_counts"]


@query("obs region gene exon", SINGLE + """, f as (select s.chrom, s.pos0, min_by(g.gene_id, (g.start, g.stop, g.gene_id)) as gene_id from s join gene g on g.chrom = s.chrom and s.pos0 >= g.start and s.pos0 < g.stop group by 1, 2),
    e as (select distinct s.chrom, s.pos0 from s join exon x on x.chrom = s.chrom and s.pos0 >= x.start and s.pos0 < x.stop)
    select b.chrom, b.pos0, b.bin_id, coalesce(f.gene_id, 'intergenic') as gene_id, case when e.chrom is not null then 'exon' when f.gene_id is not null then 'intron' else 'intergenic' end as feature_type
    from b left join f using (chrom, pos0) left join e using (chrom, pos0)""")
def single_cell_snps(obs, region, gene, exon):
    return stages.single_cell(_modalities(obs), region, gene, exon, bucket=1 << 22)["snps"].select("chrom", "pos0", "bin_id", "gene_id", "feature_type")


def _copytyping(obs, region, cellcount, gene):
    listed = cellcount.where(F.substring("barcode", 2, 9).cast("int") < 250).select("barcode").distinct()
    cells = _modalities(obs)["dna"].unionByName(_modalities(obs)["rna"])
    x = cellcount.select("barcode", F.concat(F.lit("G"), F.substring("feature_id", 2, 9)).alias("feature_id"), "value")
    return stages.copytyping(cells, region.withColumnRenamed("region_id", "bin_id"), listed, x, gene.withColumnRenamed("gene_id", "feature_id"), 1 << 22)


LISTED = "v as (select distinct barcode from cellcount where substr(barcode, 2)::int < 250)"


@query("obs region cellcount gene", f"""with {LISTED} select r.region_id as bin_id, 'B' || x.cell::varchar as barcode, sum(case when (x.pos0 // 500) % 2 = 1 then x.dp - x.ad else x.ad end)::bigint as b, sum(x.dp)::bigint as dp,
    case when sum(x.dp) > 0 then sum(case when (x.pos0 // 500) % 2 = 1 then x.dp - x.ad else x.ad end)::double / sum(x.dp)::double end as af
    from obs x join region r on r.chrom = x.chrom and x.pos0 >= r.start and x.pos0 < r.stop where 'B' || x.cell::varchar in (select barcode from v) group by 1, 2""")
def copytyping_counts(obs, region, cellcount, gene):
    return _copytyping(obs, region, cellcount, gene)["counts"]


@query("obs region cellcount gene", f"""with {LISTED}, o as (select g.gene_id, r.region_id, least(g.stop, r.stop) - greatest(g.start, r.start) as ov, r.start from gene g join region r on g.chrom = r.chrom and g.start < r.stop and r.start < g.stop),
    b as (select gene_id, region_id from (select *, row_number() over (partition by gene_id order by ov desc, start) as r from o) where r = 1)
    select b.region_id as bin_id, c.barcode, sum(c.value)::bigint as value from cellcount c join b on b.gene_id = 'G' || substr(c.feature_id, 2) where c.barcode in (select barcode from v) group by 1, 2""")
def copytyping_features(obs, region, cellcount, gene):
    return _copytyping(obs, region, cellcount, gene)["features"]


# settings of the bulk stage for these tables, as its SQL has them
BULK = Config(phase=Phase(min_depth=1), bins=Bins(min_snp_reads=300, min_snp_per_block=3, max_blocksize=400_000))

def bulk_sql(normal: bool = True, flips: bool = True, ps: str = "1", windows: str = "win") -> str:
    """The bulk bins in SQL, up to `bins` (windows), `hit` (SNPs) and `e` (phased counts); with or without a normal sample, phase flips and phase sets."""
    grp = "region_id, ps, phase_group" if flips else "region_id, ps"
    tumours = ("A", "R") if normal else ("A", "N", "R")
    balance = f"join (select chrom, pos0 from snp_sample where sample_id = 'N' and round({BETA.replace('(ad + 1)', '(dp - ad + 1)')}, 9) between 0.025 and 0.975) n using (chrom, pos0)" if normal else ""
    one = lambda text, sep=", ": sep.join(text.format(t=t.lower(), s=t) for t in tumours)
    full = f"({one('x{t} >= 300', ' and ')} and k >= 3) or e - s >= 400000"
    mode = lambda c: f"md_{c} as (select chrom, start, {c} from (select *, row_number() over (partition by chrom, start order by c desc, {c}) as r from (select chrom, start, {c}, count(*) as c from hit group by 1, 2, 3)) where r = 1)"
    votes = ["ps", "phase_group"] if flips else ["ps"]
    on = " and ".join(f"r.{c} = f.{c}" for c in grp.split(", "))
    return f"""recursive with k as (select chrom, chrom_ord, pos0 from snp_sample group by 1, 2, 3 having count(*) = 3 and min(dp) >= 1),
    m as (select k.* from k {balance}
      where exists (select 1 from region r where r.chrom = k.chrom and k.pos0 >= r.start and k.pos0 < r.stop) and not exists (select 1 from blacklist b where b.chrom = k.chrom and k.pos0 >= b.start and k.pos0 < b.stop)),
    e as (select x.*, case when (pos0 // 500) % 2 = 1 then dp - ad else ad end as b from snp_sample x join m using (chrom, chrom_ord, pos0)),
    q as (select *, 1 - {_tail(0.45, 'b + 1', '(dp + 1)')} > 0.975 as lo, 1 - {_tail(0.55, 'b + 1', '(dp + 1)')} < 0.025 as hi from e {"where sample_id <> 'N'" if normal else ""}),
    wide as (select chrom, chrom_ord, pos0, {ps} as ps, {one("bool_or(lo) filter (sample_id = '{s}') as lo_{t}, bool_or(hi) filter (sample_id = '{s}') as hi_{t}, sum(dp) filter (sample_id = '{s}')::bigint as dp_{t}")} from q group by 1, 2, 3),
    inr as (select wide.*, r.region_id from wide join region r on r.chrom = wide.chrom and wide.pos0 >= r.start and wide.pos0 < r.stop),
    f as (select *, coalesce({one('(lag(lo_{t}) over w and hi_{t}) or (lag(hi_{t}) over w and lo_{t})', ' or ')}, false) as flip from inr window w as (partition by region_id, ps order by pos0)),
    l as (select *, sum(flip::int) over (partition by region_id, ps order by pos0)::bigint as lb from f), g as (select region_id, ps, max(lb) + 1 as c, min((chrom_ord, pos0)) as o from l group by 1, 2),
    a as (select region_id, ps, coalesce(sum(c) over (order by o rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from g), pg as (select l.*, ahead + lb as phase_group from l join a using (region_id, ps)),
    ww as (select w.*, r.region_id from {windows} w join region r on r.chrom = w.chrom and (w.start + w.stop) // 2 >= r.start and (w.start + w.stop) // 2 < r.stop),
    hit as (select pg.chrom, pg.chrom_ord, pg.pos0, w.start, pg.ps, pg.phase_group, {one('pg.dp_{t}')} from pg join {windows} w on w.chrom = pg.chrom and pg.pos0 >= w.start and pg.pos0 < w.stop),
    tot as (select chrom, start, count(*) as ns, {one('sum(dp_{t})::bigint as r{t}')} from hit group by 1, 2), {', '.join(map(mode, votes))},
    rows_ as (select p.chrom, p.chrom_ord, p.start, p.stop, p.region_id, coalesce(t.ns, 0) as ns, {one('coalesce(t.r{t}, 0) as r{t}')}, {', '.join(f"last_value(md_{c}.{c} ignore nulls) over (order by p.chrom_ord, p.start rows unbounded preceding) as {c}" for c in votes)}
      from ww p left join tot t using (chrom, start) {' '.join(f"left join md_{c} using (chrom, start)" for c in votes)}),
    rn as (select *, row_number() over (partition by {grp} order by start) as i, count(*) over (partition by {grp}) as n from rows_ where ps is not null),
    fold as (select {grp}, i, n, chrom, chrom_ord, start, stop, {one('r{t} as x{t}')}, ns as k, 0::bigint as b, start as s, stop as e from rn where i = 1
      union all select {', '.join('r.' + c for c in grp.split(', '))}, r.i, r.n, r.chrom, r.chrom_ord, r.start, r.stop, {one('case when full_ then r.r{t} else f.x{t} + r.r{t} end')}, case when full_ then r.ns else f.k + r.ns end,
        case when full_ then f.b + 1 else f.b end, case when full_ then r.start else f.s end, r.stop
      from (select *, {full} as full_ from fold) f join rn r on {on} and r.i = f.i + 1),
    z as (select {grp}, case when ({full}) and b > 0 then b else greatest(b - 1, 0) end as fin from fold where i = n),
    lbin as (select {', '.join('fold.' + c for c in grp.split(', '))}, fold.chrom, fold.chrom_ord, fold.start, fold.stop, least(fold.b, z.fin) as lb from fold join z using ({grp})),
    gb as (select {grp}, max(lb) + 1 as c, min((chrom_ord, start)) as o from lbin group by {grp}), ab as (select {grp}, coalesce(sum(c) over (order by o rows between unbounded preceding and 1 preceding), 0)::bigint as ahead from gb),
    bins as (select lbin.chrom, lbin.chrom_ord, lbin.start, lbin.stop, (ahead + lb)::bigint as bin_id, {'phase_group' if flips else 'null::bigint as phase_group'}, region_id from lbin join ab using ({grp})
      union all select chrom, chrom_ord, start, stop, 0, null, region_id from rows_ where ps is null)"""


BULK_SQL = bulk_sql()


def _bulk(snp_sample, region, blacklist, win):
    x = _phased(snp_sample)
    good = stages.masked(x, region, blacklist, "N", 3, BULK, bucket=1 << 20)
    return stages.bulk_bins(x, good, region, win, "N", ["A", "N", "R"], BULK, 1 << 20)


@query("snp_sample region blacklist win", BULK_SQL + """
    select bins.bin_id, e.sample_id, sum(e.b)::bigint as b, sum(e.dp)::bigint as dp, sum(e.b)::double / sum(e.dp)::double as af from hit join bins using (chrom, start) join e using (chrom, pos0) group by 1, 2""")
def bulk_bin_counts(snp_sample, region, blacklist, win):
    return _bulk(snp_sample, region, blacklist, win)["bin_counts"]


@query("snp_sample region blacklist win", BULK_SQL + " select chrom, start, region_id, phase_group, bin_id from bins")
def bulk_windows(snp_sample, region, blacklist, win):
    return _bulk(snp_sample, region, blacklist, win)["windows"].select("chrom", "start", "region_id", "phase_group", "bin_id")


@query("snp_sample region blacklist win depth knot")
def bulk_ratios(snp_sample, region, blacklist, win, depth_, knot):
    return stages.bulk(_phased(snp_sample), region, blacklist, win, depth_.select("chrom", "start", "stop", "sample_id", "depth"), knot, "N", BULK, 1 << 20)["ratios"]


def _phased(snp_sample):
    return snp_sample.withColumn("phase", F.floor(F.col("pos0") / 500) % 2)


UNCORRECTED = Config(phase=Phase(min_depth=1), depth=Depth(method="none"), bins=Bins(min_snp_reads=300, min_snp_per_block=3, max_blocksize=400_000, rdr_outlier=0.02))
COMPLETE = "(select * from win semi join (select chrom, start from depth where depth is not null group by 1, 2 having count(distinct sample_id) = 3) using (chrom, start))"


def whole_sql(normal: bool, median_: bool, **how) -> str:
    """The bulk stage over uncorrected depths in SQL, up to `kept`: bins (with new_id) that have every frequency, depth and ratio."""
    tumour = "where sample_id <> 'N'" if normal else ""
    ratio = f"""mids as (select sample_id, median(depth) as mid from bd where depth > 0 group by 1), r0 as (select bin_id, sample_id, depth, case when depth > 0 then depth / mid end as rdr from bd join mids using (sample_id) {tumour})""" if median_ or not normal else """t as (select sample_id, sum(depth * (stop - start)) as total from wd group by 1),
    r0 as (select x.bin_id, x.sample_id, x.depth, case when n.depth > 0 then x.depth / n.depth * ((select total from t where sample_id = 'N') / t.total) end as rdr from bd x left join bd n on n.bin_id = x.bin_id and n.sample_id = 'N' join t on t.sample_id = x.sample_id where x.sample_id <> 'N')"""
    return bulk_sql(normal, windows=COMPLETE, **how) + f""",
    wd as (select d.chrom, d.start, d.stop, d.sample_id, d.depth, bins.bin_id from depth d join bins using (chrom, start)),
    bd as (select bin_id, sample_id, sum(depth * (stop - start)) / sum(stop - start) as depth from wd group by 1, 2), {ratio},
    rr as (select bin_id, sample_id, depth, case when rdr <= (select quantile_cont(rdr, 0.98::double) from r0) then rdr end as rdr from r0),
    sb as (select hit.chrom, hit.chrom_ord, hit.pos0, hit.ps, bins.bin_id from hit join bins using (chrom, start)),
    bc as (select sb.bin_id, e.sample_id, sum(e.b)::bigint as b, sum(e.dp)::bigint as dp from sb join e using (chrom, pos0) group by 1, 2),
    fine as (select bin_id from bc where dp > 0 group by 1 having count(*) = 3 intersect select bin_id from bd where depth is not null group by 1 having count(*) = 3 intersect select bin_id from rr where rdr is not null group by 1 having count(*) = {2 if normal else 3}),
    bb as (select bin_id, min_by(chrom, (chrom_ord, start)) as chrom, min_by(region_id, (chrom_ord, start)) as region_id, min(start) as start, max(stop) as stop from bins group by 1),
    bs as (select bin_id, count(*) as n_snps, min_by(ps, (chrom_ord, pos0)) as ps, min(pos0) + 1 as first_pos, max(pos0) + 1 as last_pos from sb group by 1),
    kept as (select bb.*, bs.n_snps, bs.ps, bs.first_pos, bs.last_pos, (row_number() over (order by bin_id) - 1)::bigint as new_id from bb join fine using (bin_id) join bs using (bin_id))"""


MAPPED = f""", p as (select distinct chrom, first_pos as pos from kept union select distinct chrom, last_pos from kept), {CM},
    d as (select b.chrom, b.new_id, s.cm as s, c.cm as e from kept b join cm s on s.chrom = b.chrom and s.pos = b.first_pos join cm c on c.chrom = b.chrom and c.pos = b.last_pos),
    sw as (select new_id, greatest(0.000001::double, (1 - exp(-2 * greatest(0, coalesce(s - lag(e) over (partition by chrom order by new_id), 0)))) / 2) as switchprob from d)
    select new_id as bin_id, chrom, start, stop, region_id, n_snps, round(switchprob, 9) as switchprob from kept join sw using (new_id)"""
BY_SETS = """ select new_id as bin_id, chrom, start, stop, region_id, n_snps, case when lag(ps) over (order by new_id) = ps then 0.05::double else 0.4999::double end as switchprob from kept"""
RATIOS = " select new_id as bin_id, sample_id, round(rr.depth, 9) as depth, round(rdr, 9) as rdr from kept join rr using (bin_id)"
SETS = "pos0 // 150000"


def _whole(snp_sample, region, blacklist, win, depth_, knot=None, normal="N", sets=False, **settings):
    x = _phased(snp_sample)
    if sets:
        x = x.withColumn("ps", F.floor(F.col("pos0") / 150_000))
    cfg = replace(UNCORRECTED, phase=replace(UNCORRECTED.phase, flip_test=settings.pop("flips", True)), bins=replace(UNCORRECTED.bins, **settings))
    return stages.bulk(x, region, blacklist, win, depth_.select("chrom", "start", "stop", "sample_id", "depth"), knot, normal, cfg, 1 << 20)


def _of_bins(out):
    return out["bins"].select("bin_id", "chrom", "start", "stop", "region_id", "n_snps", F.round("switchprob", 9).alias("switchprob"))


def _of_ratios(out):
    return out["ratios"].select("bin_id", "sample_id", F.round("depth", 9).alias("depth"), F.round("rdr", 9).alias("rdr"))


@query("snp_sample region blacklist win depth knot", whole_sql(True, False, ps=SETS) + MAPPED)
def bulk_bins_to_normal(snp_sample, region, blacklist, win, depth_, knot):
    return _of_bins(_whole(snp_sample, region, blacklist, win, depth_, knot, sets=True))


@query("snp_sample region blacklist win depth", whole_sql(True, False, ps=SETS) + RATIOS)
def bulk_ratios_to_normal(snp_sample, region, blacklist, win, depth_):
    return _of_ratios(_whole(snp_sample, region, blacklist, win, depth_, sets=True))


@query("snp_sample region blacklist win depth", whole_sql(True, True) + RATIOS)
def bulk_ratios_to_median(snp_sample, region, blacklist, win, depth_):
    return _of_ratios(_whole(snp_sample, region, blacklist, win, depth_, median_normalization=True))


@query("snp_sample region blacklist win depth", whole_sql(False, True, ps=SETS, flips=False) + BY_SETS)
def bulk_bins_of_tumours(snp_sample, region, blacklist, win, depth_):
    return _of_bins(_whole(snp_sample, region, blacklist, win, depth_, normal=None, sets=True, flips=False))


@query("snp_sample region blacklist win depth", whole_sql(False, True, ps=SETS, flips=False) + RATIOS)
def bulk_ratios_of_tumours(snp_sample, region, blacklist, win, depth_):
    return _of_ratios(_whole(snp_sample, region, blacklist, win, depth_, normal=None, sets=True, flips=False))


# ---- files written and read back ------------------------------------------------------------------------


def _text(df, *columns, sep="\t"):
    """A folder with the columns as lines of text."""
    path = scratch(df.sparkSession, "text")
    df.select(F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c for c in columns]).alias("value")).write.text(path)
    return path


@query("snp", "select chrom, pos0, ad::varchar as ad, dp::varchar as dp, '0/1' as gt from snp")
def read_variants(snp):
    path = scratch(snp.sparkSession, "vcf")
    writers.variants(genotype.vcf_lines(snp.withColumns({"oth": F.lit(0), "ref": F.lit("A"), "alt": F.lit("C"), "gt": F.lit("0/1")})), path)
    d = readers.vcf(snp.sparkSession, f"{path}/*")
    return d.select("chrom", "pos0", d["info"]["AD"].alias("ad"), d["info"]["DP"].alias("dp"), "gt")


def _indexed(snp, size):
    path = scratch(snp.sparkSession, "indexed")
    writers.indexed_variants(genotype.vcf_lines(snp.withColumns({"oth": F.lit(0), "ref": F.lit("A"), "alt": F.lit("C"), "gt": F.lit("0/1")})), size, path)
    return path


@query("snp size", "select chrom, pos0, ad::varchar as ad, dp::varchar as dp, '0/1' as gt from snp")
def read_indexed_variants(snp, size):
    d = readers.vcf(snp.sparkSession, f"{_indexed(snp, size)}/*/*.vcf.gz")
    return d.select("chrom", "pos0", d["info"]["AD"].alias("ad"), d["info"]["DP"].alias("dp"), "gt")


RANGES = [("chr3", 100_000, 400_000), ("chr3", 350_000, 900_000), ("chr14", 0, 250_000), ("chr21", 777_777, 5_000_000), ("chr99", 0, 100)]


@query("snp size", "select chrom, pos0, ad::varchar as ad from snp where " + " or ".join(f"(chrom = '{c}' and pos0 >= {a} and pos0 < {z})" for c, a, z in RANGES))
def variants_in_ranges(snp, size):
    d = bgzf.lines_in(snp.sparkSession, _indexed(snp, size), RANGES)
    f = F.split("value", "\t")
    return d.select(f[0].alias("chrom"), (f[1].cast("long") - 1).alias("pos0"), F.regexp_extract(f[7], "AD=([0-9]+)", 1).alias("ad"))


@query("win", "select chrom, start, stop from win")
def read_bed(win):
    path = scratch(win.sparkSession, "bed")
    writers.bed3(win, path)
    return readers.bed(win.sparkSession, path)


@query("score", "select chrom, start, stop, score as value from score")
def read_bedgraph(score):
    return readers.bedgraph(score.sparkSession, _text(score, "chrom", "start", "stop", "score"))


@query("signal size", "select s.chrom, start, stop, value from signal s where chrom in (select chrom from size)")
def read_bigwig(signal, size):
    path = scratch(signal.sparkSession, "bigwig")
    bigwig.write(signal.join(size, "chrom", "left_semi"), size, path)
    return bigwig.read(signal.sparkSession, path)


@query("signal size", "select s.chrom, start, stop, value from signal s where chrom in ('chr3', 'chr14') and start < 2000000 and stop > 100000")
def bigwig_ranges(signal, size):
    path = scratch(signal.sparkSession, "bigwig")
    bigwig.write(signal.join(size, "chrom", "left_semi"), size, path)
    return bigwig.read(signal.sparkSession, path).where("chrom in ('chr3', 'chr14') and start < 2000000 and stop > 100000")


def _by(df, key):
    """A tab-separated folder, headed, for each value of a column: {value: path}."""
    path = scratch(df.sparkSession, "parts")
    df.withColumn("by", F.col(key)).write.partitionBy("by").option("sep", "\t").option("header", True).option("quote", "").option("comment", "\x01").csv(path)
    return {r[0]: f"{path}/by={r[0]}" for r in df.select(key).distinct().collect()}  # a row for each sample or chromosome


@query("depth", "select chrom, start, stop, depth, sample_id from depth")
def read_depth(depth_):
    """A file for each sample; their header is a comment to the reader."""
    paths = _by(depth_.select(F.col("chrom").alias("#chrom"), "start", "stop", "depth", "sample_id"), "sample_id")
    return reduce(DataFrame.unionByName, [readers.depth(depth_.sparkSession, p, s).select("chrom", "start", "stop", "depth", "sample_id") for s, p in sorted(paths.items())])


@query("win", "select chrom, start, stop, gc, map, case when repli >= 1 then repli end as repli from win")
def read_windows(win):
    path = scratch(win.sparkSession, "windows")
    named = win.select(F.col("chrom").alias("#CHR"), F.col("start").alias("START"), F.col("stop").alias("END"), F.col("gc").alias("GC"), F.col("map").alias("MAP"), F.when(F.col("repli") >= 1, F.col("repli")).alias("REPLI"))
    writers.tsv(named, path)
    return readers.windows(win.sparkSession, path)


def _gtf(gene, feature):
    attributes = F.concat(F.lit('gene_id "'), F.col("gene_id"), F.lit('"; gene_name "x";'))
    return _text(gene, F.substring("chrom", 4, 9), F.lit("src"), F.lit(feature), F.col("start") + 1, "stop", F.lit("."), F.lit("+"), F.lit("."), attributes)


@query("gene", "select chrom, start, stop, gene_id from gene")
def read_genes(gene):
    return readers.genes(gene.sparkSession, _gtf(gene, "gene")).select("chrom", "start", "stop", "gene_id")


@query("exon", "select chrom, start, stop, gene_id from exon")
def read_exons(exon):
    return readers.exons(exon.sparkSession, _gtf(exon, "exon")).select("chrom", "start", "stop", "gene_id")


@query("size", "select chrom, size from size")
def read_chrom_sizes(size):
    return readers.chrom_sizes(size.sparkSession, _text(size, "chrom", "size", sep="  "))


@query("cellcount", "select distinct barcode || '_A' as barcode from cellcount")
def read_barcodes(cellcount):
    return readers.barcodes(cellcount.sparkSession, _text(cellcount.select("barcode").distinct(), "barcode"), "A")


@query("cellcount", "select distinct rep_id, barcode from cellcount")
def read_barcode_map(cellcount):
    path = scratch(cellcount.sparkSession, "map")
    writers.tsv(cellcount.select("rep_id", "barcode").distinct(), path)
    return readers.barcode_map(cellcount.sparkSession, path)


@query("obs", "select cell as row_id, k3 % 200 as col_id, sum(dp)::bigint as value from obs group by 1, 2")
def read_matrix_market(obs):
    x = obs.groupBy((F.col("cell") + 1).alias("i"), (F.col("k3") % 200 + 1).alias("j")).agg(F.sum("dp").alias("v"))
    rows = x.select(F.lit(2).alias("place"), F.concat_ws(" ", "i", "j", "v").alias("value"))
    top = obs.sparkSession.createDataFrame([(0, "%%MatrixMarket matrix coordinate integer general"), (1, "500 200 0")], "place int, value string")
    path = scratch(obs.sparkSession, "matrix")
    top.unionByName(rows).repartitionByRange(4, "place", "value").sortWithinPartitions("place", "value").select("value").write.text(path)
    return readers.matrix_market(obs.sparkSession, path)


CELLS = "with b as (select barcode, row_number() over (order by barcode) - 1 as row_id from (select distinct barcode from cellcount)), f as (select feature_id, row_number() over (order by feature_id) - 1 as col_id from (select distinct feature_id from cellcount)) select row_id, col_id, sum(value)::double as value from cellcount join b using (barcode) join f using (feature_id)"


def _sharded(cellcount):
    """The matrix of barcodes and features in shards of 64 rows."""
    b, f = counts.dense_ids(cellcount, "barcode", "row_id"), counts.dense_ids(cellcount, "feature_id", "col_id")
    path = scratch(cellcount.sparkSession, "csr")
    writers.csr(cellcount.join(b, "barcode").join(f, "feature_id").select("row_id", "col_id", "value"), b.count(), f.count(), path, 64)
    return path


@query("cellcount", CELLS + " group by 1, 2 having sum(value) <> 0")
def read_csr(cellcount):
    return readers.csr(cellcount.sparkSession, _sharded(cellcount))


@query("cellcount", CELLS + " where row_id >= 100 and row_id < 180 group by 1, 2 having sum(value) <> 0")
def csr_rows(cellcount):
    return readers.csr(cellcount.sparkSession, _sharded(cellcount), 100, 180)


@query("obs", "select chrom, pos0 as start, pos0 + 100 as stop, 'B' || cell::varchar as barcode, dp as count from obs where cell < 100")
def read_fragments(obs):
    b = F.concat(F.lit("B"), F.col("cell").cast("string"))
    path = _text(obs, "chrom", "pos0", F.col("pos0") + 100, b, "dp")
    white = obs.where("cell < 100").select(b.alias("barcode"))
    return readers.fragments(obs.sparkSession, path, white).select("chrom", "start", "stop", "barcode", "count")


@query("knot", "select chrom, pos, round(cm, 9) as cm from knot")
def read_eagle_map(knot):
    path = scratch(knot.sparkSession, "eagle")
    writers.eagle_map(knot, path)
    return readers.eagle_map(knot.sparkSession, path).withColumn("cm", F.round("cm", 9))


@query("knot", "select chrom, pos, round(cm, 9) as cm from knot")
def read_shapeit_map(knot):
    """A file for each chromosome."""
    paths = _by(knot.select("pos", F.lit(1.0).alias("rate"), F.col("cm").alias("cM"), "chrom"), "chrom")
    return readers.shapeit_map(knot.sparkSession, paths).withColumn("cm", F.round("cm", 9))


@query("cellcount", "select distinct barcode, case when substr(barcode, 2)::int % 3 = 0 then 'normal' when substr(barcode, 2)::int % 3 = 1 then 'tumor' else 'immune' end as label from cellcount")
def read_annotations(cellcount):
    k = F.substring("barcode", 2, 9).cast("int") % 3
    path = scratch(cellcount.sparkSession, "labels")
    writers.tsv(cellcount.select("barcode").distinct().select(F.col("barcode").alias("Barcode"), F.when(k == 0, "NA").when(k == 1, "T1").otherwise("T1_immune").alias("Microregion_annotation")), path)
    return readers.annotations(cellcount.sparkSession, path)


@query("gene", "select distinct brand as gene from gene")
def read_gene_list(gene):
    return readers.gene_list(gene.sparkSession, _text(gene.select("brand").distinct(), "brand"))


@query("cellcount", "select barcode, feature_id, sum(value)::bigint as value from cellcount group by 1, 2")
def read_annotated_matrix(cellcount):
    x = cellcount.groupBy("barcode", "feature_id").agg(F.sum("value").alias("value"))
    path = scratch(cellcount.sparkSession, "annotated")
    writers.annotated_matrix(x.select("barcode").distinct(), x.select("feature_id").distinct(), x, path)
    return readers.annotated_matrix(cellcount.sparkSession, path)["x"]


@query("variant", "select chrom, pos0 + 1 as pos from variant where pos0 % 3 <> 0")
def panel_sites(variant):
    d = variant.select("chrom", (F.col("pos0") + 1).alias("pos"), F.lit("A").alias("ref"), F.when(F.col("pos0") % 3 == 0, "CA").otherwise("C").alias("alt"))
    return readers.panel_sites(d)
