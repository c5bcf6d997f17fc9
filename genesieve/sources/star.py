"""Domain tables derived from the star schema, as SQL that Spark and DuckDB both read.

Each view names the views or tables that it reads as ``{name}``. Spark gets them as
DataFrames, DuckDB as common table expressions, so both engines start from the
same rows and only the operators differ.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from genesieve.operators.distance import nearest_starts
from genesieve.schema import LOCUS as LOCUS_COLUMNS
from genesieve.sources.scratch import laid_out, materialise

#: Added before rounding to 6 places, so that decimals that end in 5 are rounded alike whatever their last bits.
NUDGE = 3.7e-10

TABLES = ("orders", "lineitem", "part")
GENE = "'ENSG' || lpad(CAST({0} AS STRING), 11, '0')"
LOCUS = "'S' || CAST(o_custkey % 50 AS STRING) AS study_id, CAST(o_orderkey % 22 + 1 AS STRING) AS chrom, (o_orderkey * 104729 + o_custkey * 611953) % 50000000 AS pos, CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'C' END AS ref, 'T' AS alt"
N = "CAST(substr(study_id, 2) AS BIGINT)"

VIEWS = {
    "genes_raw": f"""SELECT {GENE.format('p_partkey')} AS gene_id, CAST(p_partkey % 22 + 1 AS STRING) AS chr,
        (p_partkey * 7919) % 50000000 AS gene_start, (p_partkey * 7919) % 50000000 + CAST(p_size AS BIGINT) * 2000 AS gene_end,
        CASE WHEN p_partkey % 2 = 0 THEN (p_partkey * 7919) % 50000000 ELSE (p_partkey * 7919) % 50000000 + CAST(p_size AS BIGINT) * 2000 END AS tss,
        p_partkey % 2 = 0 AS fwdstrand, 'N' || CAST(p_partkey AS STRING) AS gene_name, p_name AS description,
        CASE WHEN p_type IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO') THEN 'protein_coding' ELSE 'lincRNA' END AS biotype FROM {{part}}""",
    "genes": "SELECT gene_id, chr AS chrom, gene_start, gene_end, tss FROM {genes_raw}",
    "loci": f"SELECT o_orderkey, {LOCUS}, o_totalprice / 10000 AS neglog_p, o_orderpriority FROM {{orders}}",
    "toploci_raw": "SELECT study_id, chrom, pos, ref, alt, CAST(1 + o_orderkey % 9 AS DOUBLE) AS pval_mantissa, CAST(-(o_orderkey % 40) AS INT) AS pval_exponent FROM {loci}",
    "lines": """SELECT l.*, o.study_id, o.chrom, o.pos, o.ref, o.alt,
        CAST(floor((o.pos + (l.l_linenumber - 4) * 1000) / 1000.0) AS BIGINT) * 1000 AS tag_pos
        FROM {lineitem} l JOIN {loci} o ON l.l_orderkey = o.o_orderkey""",
    "tag_sums": "SELECT study_id, chrom, pos, ref, alt, tag_pos, sum(CAST(l_quantity AS BIGINT)) AS q FROM {lines} GROUP BY study_id, chrom, pos, ref, alt, tag_pos",
    "tag_runs": """SELECT *, sum(q) OVER (PARTITION BY study_id, chrom, pos, ref, alt) AS total,
        sum(q) OVER (PARTITION BY study_id, chrom, pos, ref, alt ORDER BY q DESC, tag_pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - q AS before FROM {tag_sums}""",
    "tags": """SELECT study_id, chrom, pos, ref, alt, chrom AS tag_chrom, tag_pos, 'A' AS tag_ref, 'G' AS tag_alt,
        CAST(q AS DOUBLE) / CAST(total AS DOUBLE) AS weight, before * 100 < total * 95 AS in95 FROM {tag_runs}""",
    "evidence": f"SELECT chrom AS tag_chrom, tag_pos, 'A' AS tag_ref, 'G' AS tag_alt, {GENE.format('l_partkey')} AS gene_id, max(l_discount) AS score FROM {{lines}} GROUP BY chrom, tag_pos, l_partkey",
    "dhs_evidence": f"SELECT chrom AS tag_chrom, tag_pos, 'A' AS tag_ref, 'G' AS tag_alt, {GENE.format('l_partkey')} AS gene_id, max(l_tax) AS score FROM {{lines}} WHERE l_returnflag <> 'N' GROUP BY chrom, tag_pos, l_partkey",
    "enhancer_evidence": f"SELECT chrom AS tag_chrom, tag_pos, 'A' AS tag_ref, 'G' AS tag_alt, {GENE.format('l_partkey')} AS gene_id, max(l_discount * l_tax) AS score FROM {{lines}} WHERE l_linestatus = 'F' GROUP BY chrom, tag_pos, l_partkey",
    "tissue_evidence": f"SELECT chrom AS tag_chrom, tag_pos, 'A' AS tag_ref, 'G' AS tag_alt, {GENE.format('l_partkey')} AS gene_id, l_returnflag AS tissue, max(l_discount) AS score FROM {{lines}} GROUP BY chrom, tag_pos, l_partkey, l_returnflag",
    "contacts": f"""SELECT chrom, tag_pos - CAST(l_quantity AS BIGINT) * 50 AS "start", tag_pos + CAST(l_quantity AS BIGINT) * 50 AS "end", l_discount AS score, l_returnflag AS tissue, {GENE.format('l_partkey')} AS gene_id FROM {{lines}}""",
    "transcripts": f"SELECT chrom, tag_pos AS pos, 'A' AS ref, 'G' AS alt, {GENE.format('l_partkey')} AS gene_id, 'T' || CAST(l_suppkey AS STRING) AS transcript_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE max(l_tax) END AS polyphen_score FROM {{lines}} GROUP BY chrom, tag_pos, l_partkey, l_suppkey, l_linenumber",
    "fm_gwas": f"""SELECT CASE WHEN {N} % 10 = 8 THEN 'eqtl' ELSE 'gwas' END AS type, study_id, 'F' AS bio_feature, 'P' || CAST(pos % 100 AS STRING) AS phenotype_id,
        chrom AS lead_chrom, pos AS lead_pos, ref AS lead_ref, alt AS lead_alt, tag_chrom, tag_pos, tag_ref, tag_alt,
        weight AS postprob, in95 AS is95_credset, CAST(0.01 AS DOUBLE) / CAST(1 + tag_pos % 7 AS DOUBLE) AS tag_pval_cond FROM {{tags}} WHERE {N} % 2 = 0 AND (tag_pos / 1000) % 3 <> 0""",
    "qtl_sums": """SELECT l_orderkey, CASE l_linenumber % 3 WHEN 0 THEN 'eqtl' WHEN 1 THEN 'sqtl' ELSE 'pqtl' END AS type, 'Q' || CAST(l_suppkey % 10 AS STRING) AS study_id,
        l_returnflag AS bio_feature, l_partkey, chrom, tag_pos, min(tag_pos) OVER (PARTITION BY l_orderkey) AS lead_pos, max(l_quantity) AS q, max(l_linenumber) AS line
        FROM {lines} GROUP BY l_orderkey, l_linenumber % 3, l_suppkey % 10, l_returnflag, l_partkey, chrom, tag_pos""",
    "fm_qtl": f"""SELECT type, study_id, bio_feature,
        CASE WHEN l_partkey % 5 = 0 THEN 'chr1:10:20^' || {GENE.format('l_partkey')} || '.5' WHEN l_partkey % 7 = 0 THEN 'ABC' || CAST(l_partkey AS STRING) ELSE 'P' || CAST(l_partkey AS STRING) END AS phenotype_id,
        chrom AS lead_chrom, lead_pos, 'A' AS lead_ref, 'G' AS lead_alt, chrom AS tag_chrom, tag_pos, 'A' AS tag_ref, 'G' AS tag_alt,
        max(q / 100) AS postprob, true AS is95_credset, CAST(min(line) AS DOUBLE) / 1000 AS tag_pval_cond FROM {{qtl_sums}} GROUP BY type, study_id, bio_feature, l_partkey, chrom, lead_pos, tag_pos""",
    "fm_raw": "SELECT * FROM {fm_gwas} UNION ALL SELECT * FROM {fm_qtl}",
    "pics_raw": """SELECT study_id, chrom AS lead_chrom, pos AS lead_pos, ref AS lead_ref, alt AS lead_alt, tag_chrom, tag_pos, tag_ref, tag_alt,
        CASE WHEN tag_pos % 11000 = 0 THEN 0.0005E0 ELSE weight * 0.5E0 END AS pics_postprob, in95 AS pics_95perc_credset FROM {tags}""",
    "phenotype_lut": f"SELECT 'P' || CAST(p_partkey AS STRING) AS phenotype_id, {GENE.format('p_partkey')} AS gene_id FROM {{part}} WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0",
    "coloc_raw": f"""SELECT l.study_id AS left_study, l.chrom AS left_chrom, l.pos AS left_pos, l.ref AS left_ref, l.alt AS left_alt,
        CASE WHEN l.l_linenumber = 6 THEN 'gwas' WHEN l.l_linenumber % 3 = 0 THEN 'eqtl' WHEN l.l_linenumber % 3 = 1 THEN 'sqtl' ELSE 'pqtl' END AS right_type,
        'Q' || CAST(l.l_suppkey % 10 AS STRING) AS right_study, l.l_returnflag AS right_bio_feature,
        CASE WHEN l.l_partkey % 5 = 0 THEN 'chr1^10^20^' || {GENE.format('l.l_partkey')} || '.5' ELSE 'P' || CAST(l.l_partkey AS STRING) END AS right_phenotype,
        l.chrom AS right_chrom, min(l.tag_pos) OVER (PARTITION BY l.l_orderkey) AS right_pos, 'A' AS right_ref, 'G' AS right_alt, {GENE.format('l.l_partkey')} AS right_gene_id,
        CAST(200 + l.l_quantity * 10 AS INT) AS coloc_n_vars, CASE WHEN l.l_suppkey % 17 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l.l_tax * 50 - 2 END AS coloc_log2_h4_h3, l.l_discount AS coloc_h4 FROM {{lines}} l""",
    "v2g_raw": f"""SELECT chrom AS chr_id, tag_pos AS position, 'A' AS ref_allele, 'G' AS alt_allele,
        CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END AS type_id, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS source_id,
        CASE WHEN l_linenumber % 2 = 0 THEN 'f' || CAST(l_suppkey % 3 AS STRING) END AS feature, CASE WHEN l_linenumber % 2 = 0 THEN l_discount END AS interval_score,
        CASE WHEN l_linenumber % 2 = 1 THEN 'csq' || CAST(l_suppkey % 4 AS STRING) END AS fpred_max_label, CASE WHEN l_linenumber % 2 = 1 THEN l_tax END AS fpred_max_score,
        {GENE.format('l_partkey')} AS gene_id FROM {{lines}}""",
    "part_pairs": "SELECT a.l_partkey AS a, b.l_partkey AS b FROM {lineitem} a JOIN {lineitem} b ON a.l_orderkey = b.l_orderkey AND a.l_partkey <> b.l_partkey GROUP BY a.l_partkey, b.l_partkey",
    "string_links": "SELECT '9606.P' || CAST(a AS STRING) AS p1, '9606.P' || CAST(b AS STRING) AS p2, 150 + (a + b) % 850 AS string_score FROM {part_pairs}",
    "string_aliases": f"""SELECT '9606.P' || CAST(p_partkey AS STRING) AS string_id, {GENE.format('p_partkey')} AS gene_id, 'ens' AS source FROM {{part}} WHERE p_partkey % 13 <> 0
        UNION ALL SELECT '9606.P' || CAST(p_partkey AS STRING), {GENE.format('p_partkey + 1')}, 'dup' FROM {{part}} WHERE p_partkey % 10 = 0
        UNION ALL SELECT '9606.P' || CAST(p_partkey AS STRING), 'XYZ' || CAST(p_partkey AS STRING), 'other' FROM {{part}}""",
    "known_genes": "SELECT gene_id, chrom, gene_start, gene_end FROM {genes} WHERE gene_start % 9 <> 0",
    "synonyms": f"SELECT {GENE.format('p_partkey')} AS gene_id, 'N' || CAST(p_partkey + 1 AS STRING) AS synonym FROM {{part}} WHERE p_partkey % 3 = 0 UNION ALL SELECT {GENE.format('p_partkey')}, 'Y' || CAST(p_partkey AS STRING) FROM {{part}} WHERE p_partkey % 2 = 0",
    "attenuation": """SELECT 'N' || CAST(p_partkey AS STRING) AS gene_name, p_retailprice / 1000 AS value FROM {part} WHERE p_partkey % 4 = 0
        UNION ALL SELECT 'Y' || CAST(p_partkey AS STRING), p_retailprice / 500 FROM {part} WHERE p_partkey % 4 = 0 OR p_partkey % 9 = 0""",
    "study_list": f"SELECT DISTINCT study_id, {N} % 3 = 0 AS has_sumstats FROM {{loci}}",
    "study_traits": f"""SELECT DISTINCT study_id, 'EFO_' || CAST({N} % 7 AS STRING) AS trait FROM {{loci}}
        UNION ALL SELECT DISTINCT study_id, 'EFO_' || CAST(10 + {N} % 5 AS STRING) FROM {{loci}} WHERE {N} % 2 = 0
        UNION ALL SELECT DISTINCT study_id, 'EFO_' || CAST(20 + {N} % 3 AS STRING) FROM {{loci}} WHERE {N} % 3 = 0""",
    "interactions": f"SELECT {GENE.format('a')} AS gene_id, {GENE.format('b')} AS partner, CAST(50 + (a + b) % 50 AS DOUBLE) / 100 AS score FROM {{part_pairs}}",
    "coloc_network": """SELECT i.gene_id AS gene_id_1, i.partner AS gene_id_2, i.score AS string_score, g.chrom AS gene_1_chrom, h.chrom AS gene_2_chrom
        FROM {interactions} i JOIN {genes} g ON i.gene_id = g.gene_id JOIN {genes} h ON i.partner = h.gene_id""",
    "gold_near": """SELECT l.study_id, l.chrom, l.pos, l.ref, l.alt, l.o_orderpriority, g.gene_id,
        row_number() OVER (PARTITION BY l.study_id, l.chrom, l.pos, l.ref, l.alt ORDER BY abs(l.pos - g.gene_start), g.gene_id) AS n
        FROM {loci} l JOIN {genes} g ON l.chrom = g.chrom AND floor(l.pos / 500000.0) = floor(g.gene_start / 500000.0)""",
    "gold_flat": """SELECT study_id, chrom, pos, ref, alt, gene_id, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'High' WHEN '2' THEN 'Medium' WHEN '3' THEN 'Low' ELSE 'Other' END AS gs_confidence,
        o_orderpriority AS gs_set FROM {gold_near} WHERE n = 1 OR (n = 2 AND pos % 5 = 0)""",
    "gold_loci": "SELECT study_id, chrom, pos, ref, alt, neglog_p FROM {loci} WHERE pos % 6 <> 0",
    "scored": """SELECT 'c' || CAST(l_suppkey % 2 AS STRING) AS clf, 'f' || CAST(l_linenumber % 3 AS STRING) AS ft, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
        CAST((l_partkey * 37 + l_suppkey * 11 + CAST(l_quantity AS BIGINT)) % 101 AS DOUBLE) / 100 AS score FROM {lineitem}""",
    "predictions": """SELECT study_id, chrom, pos, ref, alt, gene_id, 'gbt' AS training_clf, ft AS training_ft, CASE WHEN pos % 4 = 0 THEN 'high' ELSE 'high_medium' END AS training_gs,
        'fold' || CAST(pos % 5 AS STRING) AS training_fold, max(p) AS y_proba
        FROM (SELECT study_id, chrom, pos, ref, alt, 'ENSG' || lpad(CAST(l_partkey AS STRING), 11, '0') AS gene_id, CASE l_linenumber % 3 WHEN 0 THEN 'full_model' WHEN 1 THEN 'dist_foot' ELSE 'dist_tss' END AS ft, l_discount * 10 AS p FROM {lines}) x
        GROUP BY study_id, chrom, pos, ref, alt, gene_id, ft""",
}

#: What a view joins or groups its inputs by. Adaptive execution joins partitions by their compressed bytes, so a task's rows would grow with the tables;
#: for tables of many rows these inputs are laid out by such keys in as many partitions as keep one at about ``PART_LINES`` line items.
LAID = {
    "lines": {"lineitem": ("l_orderkey",), "loci": ("o_orderkey",)}, "tag_sums": {"lines": ("chrom", "pos")}, "predictions": {"lines": ("chrom", "pos")},
    "fm_qtl": {"qtl_sums": ("l_partkey", "chrom", "lead_pos")},
}
PART_LINES = 250_000

#: Views that Spark makes by an operator: of ``gold_near`` its rows with n up to 2 (no view reads others), without a pair for each locus and gene.
OPERATORS = {"gold_near": lambda s: nearest_starts(s["loci"].select(*LOCUS_COLUMNS, "o_orderpriority"), s["genes"], 500_000)}


def dependencies(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Star:
    """Views over one directory of tables, made once each."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir, self.made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            if name in OPERATORS:
                self.made[name] = OPERATORS[name](self)
            elif name in VIEWS:
                sql = VIEWS[name].replace('"start"', "`start`").replace('"end"', "`end`")
                keys = LAID.get(name, {})
                self.made[name] = self.spark.sql(sql, **{d: laid_out(self[d], self.parts, *keys[d]) if d in keys else self[d] for d in dependencies(sql)})
            else:
                self.made[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.made[name]

    @cached_property
    def parts(self) -> int:
        """Partitions of what grows with the line items; 0 if the cores have no more than one each, when Spark chooses."""
        n = -(-self["lineitem"].count() // PART_LINES)
        return n if n > self.spark.sparkContext.defaultParallelism else 0

    def stage(self, *names: str) -> None:
        """Write views to the shared folder: those that several steps of a query read are then made once."""
        for name in names:
            self.made[name] = materialise(self[name], name)


def duck_ctes(names: list[str]) -> str:
    """The views and what they read as ``name AS (...)``, in order."""
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done or name not in VIEWS:
            return
        for d in dependencies(VIEWS[name]):
            visit(d)
        done.append(name)

    for n in names:
        visit(n)
    return ",\n".join(f"{n} AS ({re.sub(r'[{](\w+)[}]', r'\1', VIEWS[n])})" for n in done)
