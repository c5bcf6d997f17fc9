"""The same queries as DuckDB SQL, written apart from the operators.

Each entry names the views it reads; shared steps are CTEs of their own. Every double
is rounded to 6 places by ``_final``.
"""

from __future__ import annotations

from genesieve.sources.star import NUDGE, VIEWS, duck_ctes

K5 = "study_id, chrom, pos, ref, alt"
K6 = K5 + ", gene_id"
TAG = "tag_chrom, tag_pos, tag_ref, tag_alt"
LEAD = "lead_chrom, lead_pos, lead_ref, lead_alt"
QTL = "qtl_study, qtl_bio_feature, qtl_phenotype, qtl_chrom, qtl_pos, qtl_ref, qtl_alt"
QTL_FROM = "study_id, bio_feature, phenotype_id, lead_chrom, lead_pos, lead_ref, lead_alt"


def _as(names: str, new: str) -> str:
    return ", ".join(f"{a.strip()} AS {b.strip()}" for a, b in zip(names.split(","), new.split(","), strict=True))


def _evidence(source: str, p: str) -> str:
    """max, max_nbh, ave, ave_nbh of one source, by joining group maxima back."""
    return f"""{p}_hits AS (SELECT t.{K5.replace(', ', ', t.')}, t.weight, t.in95, e.gene_id, e.score FROM tags t JOIN {source} e
        ON t.tag_chrom = e.tag_chrom AND t.tag_pos = e.tag_pos AND t.tag_ref = e.tag_ref AND t.tag_alt = e.tag_alt WHERE e.score IS NOT NULL),
    {p}_local AS (SELECT {K6}, max(score) FILTER (WHERE in95) AS mx, sum(score * weight) AS av FROM {p}_hits GROUP BY {K6}),
    {p}_best AS (SELECT {K5}, max(mx) AS bm, max(av) AS ba FROM {p}_local GROUP BY {K5}),
    {p}_f AS (SELECT {K6}, mx, mx / nullif(bm, 0) AS mx_nbh, av, av / nullif(ba, 0) AS av_nbh FROM {p}_local JOIN {p}_best USING ({K5}))"""


def _tissue(hits: str, p: str) -> str:
    """Ratios inside a tissue, then the best tissue for max and for ave, from a table of hits."""
    return f"""{p}_l AS (SELECT {K6}, tissue, max(score) FILTER (WHERE in95) AS mx, sum(score * weight) AS av FROM {hits} GROUP BY {K6}, tissue),
    {p}_b AS (SELECT {K5}, tissue, max(mx) AS bm, max(av) AS ba FROM {p}_l GROUP BY {K5}, tissue),
    {p}_r AS (SELECT l.*, mx / nullif(bm, 0) AS mx_nbh, av / nullif(ba, 0) AS av_nbh FROM {p}_l l JOIN {p}_b USING ({K5}, tissue)),
    {p}_m AS (SELECT {K6}, mx, mx_nbh FROM {p}_r WHERE mx IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {K6} ORDER BY mx DESC, mx_nbh DESC NULLS LAST, tissue) = 1),
    {p}_a AS (SELECT {K6}, av, av_nbh FROM {p}_r WHERE av IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {K6} ORDER BY av DESC, av_nbh DESC NULLS LAST, tissue) = 1),
    {p}_f AS (SELECT {K6}, mx, mx_nbh, av, av_nbh FROM {p}_a FULL JOIN {p}_m USING ({K6}))"""


def _four(p: str, names: str) -> str:
    return f"{_as('mx, mx_nbh, av, av_nbh', names)}"


NAMES = {
    "vep": "vep_credset_max, vep_credset_max_nbh, vep_ave, vep_ave_nbh",
    "dhs": "dhs_prmtr_max, dhs_prmtr_max_nbh, dhs_prmtr_ave, dhs_prmtr_ave_nbh",
    "enh": "enhc_tss_max, enhc_tss_max_nbh, enhc_tss_ave, enhc_tss_ave_nbh",
    "pph": "polyphen_credset_max, polyphen_credset_max_nbh, polyphen_ave, polyphen_ave_nbh",
    "pch": "pchicJung_max, pchicJung_max_nbh, pchicJung_ave, pchicJung_ave_nbh",
    "tis": "pchic_max, pchic_max_nbh, pchic_ave, pchic_ave_nbh",
}

#: Shared steps: name -> (views and steps that it reads, CTE text).
STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "coding": (("genes_raw",), "coding AS (SELECT gene_id, chr AS chrom, gene_start, gene_end, tss, fwdstrand, gene_name, description AS gene_description, biotype AS gene_biotype FROM genes_raw WHERE biotype = 'protein_coding')"),
    "qtl": (
        ("fm_raw", "phenotype_lut"),
        f"""qtl AS (SELECT type, study_id, bio_feature, f.phenotype_id, coalesce(g.gene_id, regexp_extract(f.phenotype_id, '(ENSG[0-9]+)', 1)) AS gene_id, {LEAD}, {TAG}, postprob,
        -log10(tag_pval_cond) AS qtl_neglog_p, lead_chrom = tag_chrom AND lead_pos = tag_pos AND lead_ref = tag_ref AND lead_alt = tag_alt AS is_sentinel
        FROM fm_raw f LEFT JOIN phenotype_lut g ON f.phenotype_id = g.phenotype_id WHERE type <> 'gwas' AND postprob >= 0.001)""",
    ),
    "staged_coloc": (("coloc_raw", "coding"), "staged_coloc AS (SELECT * EXCLUDE (coloc_n_vars, right_gene_id), right_gene_id AS gene_id FROM coloc_raw WHERE right_type <> 'gwas' AND coloc_n_vars >= 250 AND NOT isnan(coloc_log2_h4_h3) AND right_gene_id IN (SELECT gene_id FROM coding))"),
    "best_tr": (("transcripts",), "best_tr AS (SELECT chrom, pos, ref, alt, gene_id, transcript_id, polyphen_score FROM transcripts WHERE polyphen_score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chrom, pos, ref, alt, gene_id ORDER BY polyphen_score DESC, transcript_id) = 1)"),
    "pph_evidence": (("best_tr",), "pph_evidence AS (SELECT chrom AS tag_chrom, pos AS tag_pos, ref AS tag_ref, alt AS tag_alt, gene_id, polyphen_score AS score FROM best_tr)"),
    "vep_f": (("tags", "evidence"), _evidence("evidence", "vep")),
    "dhs_f": (("tags", "dhs_evidence"), _evidence("dhs_evidence", "dhs")),
    "enh_f": (("tags", "enhancer_evidence"), _evidence("enhancer_evidence", "enh")),
    "pph_f": (("tags", "pph_evidence"), _evidence("pph_evidence", "pph")),
    "tis_f": (
        ("tags", "tissue_evidence"),
        f"tis_hits AS (SELECT t.{K5.replace(', ', ', t.')}, t.weight, t.in95, e.gene_id, e.score, e.tissue FROM tags t JOIN tissue_evidence e ON t.tag_chrom = e.tag_chrom AND t.tag_pos = e.tag_pos AND t.tag_ref = e.tag_ref AND t.tag_alt = e.tag_alt), " + _tissue("tis_hits", "tis"),
    ),
    "pch_f": (
        ("tags", "contacts"),
        f"""pch_hits AS (SELECT DISTINCT t.{K5.replace(', ', ', t.')}, t.tag_chrom, t.tag_pos, t.tag_ref, t.tag_alt, t.weight, t.in95, c.gene_id, c.score, c.tissue FROM tags t
        JOIN contacts c ON t.tag_chrom = c.chrom AND t.tag_pos BETWEEN c."start" AND c."end"), """ + _tissue("pch_hits", "pch"),
    ),
    "near": (
        ("loci", "genes"),
        f"""near AS (SELECT l.{K5.replace(', ', ', l.')}, g.gene_id, CASE WHEN l.pos BETWEEN gene_start AND gene_end THEN 0 ELSE least(abs(l.pos - gene_start), abs(l.pos - gene_end)) END AS foot, abs(l.pos - g.tss) AS tssd
        FROM loci l JOIN genes g ON l.chrom = g.chrom AND (abs(l.pos - gene_start) <= 500000 OR abs(l.pos - gene_end) <= 500000)),
    sent AS (SELECT *, ln(foot + 1) AS lf, ln(tssd + 1) AS lt FROM near),
    sent_f AS (SELECT s.{K6.replace(', ', ', s.')}, s.foot, lf AS dist_foot_sentinel, bf - lf AS dist_foot_sentinel_nbh, lt AS dist_tss_sentinel, bt - lt AS dist_tss_sentinel_nbh
        FROM sent s JOIN (SELECT {K5}, min(lf) AS bf, min(lt) AS bt FROM sent GROUP BY {K5}) b USING ({K5})),
    density AS (SELECT {K5}, {', '.join(f'count(*) FILTER (WHERE foot <= {k}000) AS gene_count_lte_{k}k' for k in (50, 100, 250, 500))} FROM near GROUP BY {K5})""",
    ),
    "tdist": (
        ("tags", "genes"),
        f"""tnear AS (SELECT t.{K5.replace(', ', ', t.')}, t.weight, t.in95, g.gene_id, CASE WHEN tag_pos BETWEEN gene_start AND gene_end THEN 0 ELSE least(abs(tag_pos - gene_start), abs(tag_pos - gene_end)) END AS foot, abs(tag_pos - g.tss) AS tssd
        FROM tags t JOIN genes g ON t.tag_chrom = g.chrom AND (abs(tag_pos - gene_start) <= 500000 OR abs(tag_pos - gene_end) <= 500000)),
    tagg AS (SELECT {K6}, ln(min(foot) FILTER (WHERE in95) + 1) AS fm, ln(min(tssd) FILTER (WHERE in95) + 1) AS tm, ln(sum(foot * weight) + 1) AS fa, ln(sum(tssd * weight) + 1) AS ta FROM tnear GROUP BY {K6}),
    tdist AS (SELECT {K6}, fm AS dist_foot_min, xfm - fm AS dist_foot_min_nbh, tm AS dist_tss_min, xtm - tm AS dist_tss_min_nbh, fa AS dist_foot_ave, xfa - fa AS dist_foot_ave_nbh, ta AS dist_tss_ave, xta - ta AS dist_tss_ave_nbh
        FROM tagg JOIN (SELECT {K5}, min(fm) AS xfm, min(tm) AS xtm, min(fa) AS xfa, min(ta) AS xta FROM tagg GROUP BY {K5}) b USING ({K5}))""",
    ),
    "spine": (
        ("near", "tdist"),
        f"""spine AS (SELECT s.* EXCLUDE (foot), {', '.join(f't.dist_{d}_{a}{n}' for d in ('foot', 'tss') for a in ('min', 'ave') for n in ('', '_nbh'))}, {', '.join(f'd.gene_count_lte_{k}k' for k in (50, 100, 250, 500))}
        FROM sent_f s LEFT JOIN tdist t USING ({K6}) LEFT JOIN density d USING ({K5}) WHERE s.dist_foot_sentinel <= ln(500000))""",
    ),
    "lead_p": (("qtl",), f"lead_p AS (SELECT {_as(QTL_FROM, QTL)}, max(qtl_neglog_p) AS p, min(qtl_neglog_p) AS neglogp FROM qtl WHERE is_sentinel GROUP BY {QTL_FROM})"),
    "clpp": (
        ("tags", "qtl", "lead_p"),
        f"""clpp_s AS (SELECT t.{K5.replace(', ', ', t.')}, q.gene_id, q.type AS qtl_type, {', '.join('q.' + x for x in _as(QTL_FROM, QTL).split(', '))}, CASE WHEN sum(t.weight * q.postprob) > 0 THEN ln(sum(t.weight * q.postprob)) END AS score
        FROM tags t JOIN qtl q USING ({TAG}) GROUP BY ALL), """ + f"""clpp_b AS (SELECT c.*, p.neglogp FROM clpp_s c LEFT JOIN lead_p p USING ({QTL})
        QUALIFY row_number() OVER (PARTITION BY {K6}, qtl_type ORDER BY score DESC NULLS LAST, neglogp DESC NULLS LAST, {QTL}) = 1),
    clpp_g AS (SELECT *, score - max(score) OVER (PARTITION BY {K5}, qtl_type) AS gap FROM clpp_b),
    clpp AS (SELECT {K6}, {', '.join(f"max(CASE WHEN qtl_type = '{t}' THEN {c} END) AS {t}_pics_clpp_{n}" for t in ('eqtl', 'sqtl', 'pqtl') for c, n in (('score', 'max'), ('neglogp', 'max_neglogp'), ('gap', 'max_nhb')))} FROM clpp_g GROUP BY {K6})""",
    ),
    "llr": (
        ("staged_coloc", "qtl"),
        f"""fm_p AS (SELECT study_id AS qtl_study, bio_feature AS qtl_bio_feature, replace(phenotype_id, ':', '^') AS qtl_phenotype, {_as(LEAD, 'qtl_chrom, qtl_pos, qtl_ref, qtl_alt')}, min(qtl_neglog_p) AS neglogp FROM qtl WHERE is_sentinel GROUP BY ALL),
    llr_s AS (SELECT {_as('left_study, left_chrom, left_pos, left_ref, left_alt', K5)}, gene_id, right_type AS qtl_type, {_as('right_study, right_bio_feature, right_phenotype, right_chrom, right_pos, right_ref, right_alt', QTL)}, coloc_log2_h4_h3 AS score FROM staged_coloc),
    llr_b AS (SELECT c.*, p.neglogp FROM llr_s c LEFT JOIN fm_p p USING ({QTL})
        QUALIFY row_number() OVER (PARTITION BY {K6}, qtl_type ORDER BY score DESC NULLS LAST, neglogp DESC NULLS LAST, {QTL}) = 1),
    llr_g AS (SELECT *, score - max(score) OVER (PARTITION BY {K5}, qtl_type) AS gap FROM llr_b),
    llr AS (SELECT {K6}, {', '.join(f"max(CASE WHEN qtl_type = '{t}' THEN {c} END) AS {t}_coloc_llr_{n}" for t in ('eqtl', 'sqtl', 'pqtl') for c, n in (('score', 'max'), ('neglogp', 'max_neglogp'), ('gap', 'max_nbh')))} FROM llr_g GROUP BY {K6})""",
    ),
    "csize": (("tags",), f"csize AS (SELECT {K5}, count(*) AS count_credset_95 FROM tags WHERE in95 GROUP BY {K5})"),
    "resolved": (
        ("genes_raw", "synonyms", "attenuation"),
        """names AS (SELECT gene_name, gene_id FROM genes_raw UNION ALL SELECT synonym, gene_id FROM synonyms WHERE synonym NOT IN (SELECT gene_name FROM genes_raw)),
    ids AS (SELECT gene_name, min(gene_id) AS gene_id FROM names GROUP BY gene_name), resolved AS (SELECT a.gene_name, a.value, i.gene_id FROM attenuation a LEFT JOIN ids i USING (gene_name)),
    per_gene AS (SELECT gene_id, gene_name, value FROM resolved WHERE gene_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY gene_name, value) = 1)""",
    ),
    "clusters": (
        ("loci", "tags"),
        f"""held AS (SELECT DISTINCT concat_ws(':', {K5}) AS locus, concat_ws(':', {TAG}) AS tag FROM tags WHERE weight >= 0.001),
    links AS (SELECT DISTINCT a.locus AS u, b.locus AS v FROM held a JOIN held b USING (tag)),
    reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
    found AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
    clusters AS (SELECT DISTINCT l.{K5.replace(', ', ', l.')}, coalesce(c, 'cluster_unknown') AS cluster_label FROM loci l LEFT JOIN found ON concat_ws(':', {', '.join('l.' + k for k in K5.split(', '))}) = u)""",
    ),
    "gold": (
        ("gold_flat", "gold_loci", "clusters"),
        f"""attached AS (SELECT g.*, c.cluster_label, p.neglog_p, CASE gs_confidence WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 WHEN 'Low' THEN 3 END AS gs_confidence_num
        FROM gold_flat g LEFT JOIN clusters c USING ({K5}) LEFT JOIN gold_loci p USING ({K5}) WHERE gs_confidence <> 'Other'),
    gold AS (SELECT * FROM attached WHERE neglog_p IS NOT NULL AND cluster_label <> 'cluster_unknown'
        QUALIFY row_number() OVER (PARTITION BY cluster_label, gene_id ORDER BY gs_confidence_num, neglog_p DESC, gs_set, {K5}) = 1)""",
    ),
    "labelled": (
        ("near", "gold", "coloc_network"),
        f"""close AS (SELECT DISTINCT gene_id_1, gene_id_2 FROM coloc_network WHERE string_score >= 0.9 AND gene_1_chrom = gene_2_chrom),
    pairs AS (SELECT s.{K6.replace(', ', ', s.')}, g.gene_id = s.gene_id AS own, c.gene_id_1 IS NOT NULL AS close_by, g.gs_confidence_num, g.gs_set, g.gs_confidence
        FROM sent_f s JOIN gold g USING ({K5}) LEFT JOIN close c ON s.gene_id = c.gene_id_1 AND g.gene_id = c.gene_id_2),
    status AS (SELECT {K6}, CASE WHEN bool_or(own) THEN 1 WHEN bool_or(close_by) THEN -1 ELSE 0 END AS gold_standard_status, min((gs_confidence_num, gs_set, gs_confidence)) AS i FROM pairs GROUP BY {K6}),
    labelled AS (SELECT s.{K6.replace(', ', ', s.')}, t.gold_standard_status, t.i[1] AS gs_confidence_num, t.i[2] AS gs_set, t.i[3] AS gs_confidence FROM sent_f s LEFT JOIN status t USING ({K6}))""",
    ),
    "context": (
        ("near", "clusters", "study_traits"),
        f"""context AS (SELECT s.{K6.replace(', ', ', s.')}, c.cluster_label FROM sent_f s JOIN clusters c USING ({K5}) WHERE s.foot < 500000),
    overlap AS (SELECT DISTINCT a.study_id AS a, b.study_id AS b FROM study_traits a JOIN study_traits b USING (trait))""",
    ),
}


def _interlocus(by_trait: bool) -> str:
    p = "interlocus_trait" if by_trait else "interlocus_study"
    on = "t.study_id IN (SELECT b FROM overlap WHERE a = s.study_id)" if by_trait else "t.study_id = s.study_id"
    loci = "SELECT o.a AS study_id, count(DISTINCT cluster_label) AS n FROM overlap o JOIN context c ON c.study_id = o.b GROUP BY o.a" if by_trait else "SELECT study_id, count(DISTINCT cluster_label) AS n FROM context GROUP BY study_id"
    return f"""WITH_ m AS (SELECT DISTINCT s.{K6.replace(', ', ', s.')}, i.partner, i.score, t.cluster_label AS target FROM context s JOIN interactions i ON s.gene_id = i.gene_id
        JOIN context t ON t.gene_id = i.partner AND t.cluster_label <> s.cluster_label AND {on}),
    w AS (SELECT {K6}, target, 1.0::DOUBLE / count(DISTINCT partner) AS w FROM m GROUP BY {K6}, target),
    o AS (SELECT m.*, w.w FROM m JOIN w USING ({K6}, target) QUALIFY row_number() OVER (PARTITION BY {K6}, partner ORDER BY w DESC, target, score DESC) = 1),
    n AS ({loci})
    SELECT {K6}, sum(score) AS {p}_unweighted, sum(score * w) AS {p}_target_weighted, sum(score / n) AS {p}_loci_weighted, sum(score * w / n) AS {p}_both_weighted,
        string_agg(partner || ':' || CAST(trunc(score * 100) AS INT), ',' ORDER BY partner, score) AS {p}_partners FROM o JOIN n USING (study_id) GROUP BY {K6}"""


def _interlocus_both() -> str:
    study, trait = (_interlocus(x).replace("WITH_", "WITH", 1) for x in (False, True))
    return f"WITH_ by_study AS ({study}), by_trait AS ({trait}) SELECT * FROM by_study JOIN by_trait USING ({K6})"


THRESHOLDS = """WITH_ e AS (SELECT clf, ft, score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS n FROM scored GROUP BY clf, ft, score),
    t AS (SELECT *, sum(p) OVER d AS tp, sum(n) OVER d AS fp, sum(p) OVER g AS ap, sum(n) OVER g AS an FROM e WINDOW d AS (PARTITION BY clf, ft ORDER BY score DESC), g AS (PARTITION BY clf, ft))"""
CONFUSION = """WITH_ c AS (SELECT clf, ft, count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND score >= 0.5) AS fp,
    count(*) FILTER (WHERE label <> 1 AND score < 0.5) AS tn, count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn FROM scored GROUP BY clf, ft)
    SELECT *, tp + fp + tn + fn AS support, (tp + tn) / (tp + fp + tn + fn) AS accuracy, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall, tp / nullif(tp + fn, 0) AS tpr,
    tn / nullif(tn + fp, 0) AS tnr, fp / nullif(fp + tn, 0) AS fpr, fn / nullif(fn + tp, 0) AS fnr, fp / nullif(fp + tp, 0) AS fdr, 2 * tp / nullif(2 * tp + fp + fn, 0) AS f1,
    (tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2 AS balanced_accuracy FROM c"""


def _features(p: str) -> str:
    return f"SELECT {K6}, {_four(p, NAMES[p])} FROM {p}_f"


def _folds() -> dict[str, int]:
    """heldout_scores assigns chromosomes with n positives on chromosome n, plus X: written out by hand-run of the greedy rule."""
    order = sorted(map(str, range(1, 23))) + ["X"]
    load, fold = [0] * 5, {}
    for c in order:
        i = load.index(min(load))
        fold[c] = i
        load[i] += int(c) if c != "X" else 0
    return fold


MATRIX = f"""SELECT s.*, {', '.join(f'{p}.{a.strip()} AS {b.strip()}' for p in ('vep', 'dhs', 'enh', 'pph', 'pch') for a, b in zip('mx, mx_nbh, av, av_nbh'.split(','), NAMES[p].split(','), strict=True))},
    clpp.* EXCLUDE ({K6}), llr.* EXCLUDE ({K6}), csize.count_credset_95, study_list.has_sumstats, per_gene.value AS "proteinAttenuation"
    FROM spine s LEFT JOIN vep_f vep USING ({K6}) LEFT JOIN dhs_f dhs USING ({K6}) LEFT JOIN enh_f enh USING ({K6}) LEFT JOIN pph_f pph USING ({K6}) LEFT JOIN pch_f pch USING ({K6})
    LEFT JOIN clpp USING ({K6}) LEFT JOIN llr USING ({K6}) LEFT JOIN csize USING ({K5}) LEFT JOIN study_list USING (study_id) LEFT JOIN per_gene USING (gene_id)"""

#: Query -> (views and steps, SQL). ``WITH_`` continues the list of CTEs.
DROPOUT = """SELECT 'p_value' AS stage, gs_set, count(neglog_p) AS n_kept, count(*) - count(neglog_p) AS n_lost FROM attached GROUP BY gs_set
        UNION ALL SELECT 'cluster', gs_set, count(*) FILTER (WHERE cluster_label <> 'cluster_unknown'), count(*) FILTER (WHERE cluster_label = 'cluster_unknown') FROM attached WHERE neglog_p IS NOT NULL GROUP BY gs_set
        UNION ALL SELECT 'chosen', gs_set, count(*), 0 FROM gold GROUP BY gs_set
        UNION ALL SELECT 'labelled', gs_set, count(*) FILTER (WHERE gold_standard_status = 1), count(*) FILTER (WHERE gold_standard_status <> 1) FROM labelled WHERE gs_set IS NOT NULL GROUP BY gs_set"""

QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "scan_project_filter": (
        (),
        """SELECT l_orderkey, l_partkey, l_linenumber AS line, l_extendedprice * (1 - l_discount) AS net FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag = 'R' AND l_linestatus <> 'O' AND l_quantity >= 10 AND p_type IN ('ECONOMY', 'PROMO') AND p_brand NOT IN ('Brand#3') AND l_shipdate IS NOT NULL AND starts_with(p_brand, 'Brand#1') AND l_linenumber <> p_size""",
    ),
    "neglog_p": (("toploci_raw",), f"SELECT {K5}, -(log10(pval_mantissa) + pval_exponent) AS neglog_p FROM toploci_raw"),
    "credset_unify": (
        ("fm_raw", "pics_raw"),
        f"""WITH_ f AS (SELECT study_id, {LEAD}, {TAG}, postprob AS fm_postprob, is95_credset AS fm_is95 FROM fm_raw WHERE type = 'gwas' AND postprob >= 0.001),
        p AS (SELECT study_id, {LEAD}, {TAG}, pics_postprob, pics_95perc_credset AS pics_is95 FROM pics_raw WHERE pics_postprob >= 0.001), h AS (SELECT DISTINCT study_id FROM fm_raw)
        SELECT *, CASE WHEN study_id IN (FROM h) THEN fm_postprob ELSE pics_postprob END AS combined_postprob, CASE WHEN study_id IN (FROM h) THEN fm_is95 ELSE pics_is95 END AS combined_is95
        FROM f FULL JOIN p USING (study_id, {LEAD}, {TAG})""",
    ),
    "qtl_prepare": (("qtl",), "SELECT * FROM qtl"),
    "coloc_prepare": (("staged_coloc",), "SELECT * FROM staged_coloc"),
    "mixed_split_interval": (("v2g_raw",), "SELECT DISTINCT chr_id AS chrom, position AS pos, ref_allele AS ref, alt_allele AS alt, type_id AS interval_type, source_id AS interval_source, feature AS interval_feature, interval_score, gene_id FROM v2g_raw WHERE type_id IS NOT NULL AND source_id IS NOT NULL AND feature IS NOT NULL AND interval_score IS NOT NULL AND gene_id IS NOT NULL"),
    "mixed_split_consequence": (("v2g_raw",), "SELECT DISTINCT chr_id AS chrom, position AS pos, ref_allele AS ref, alt_allele AS alt, fpred_max_label AS csq, fpred_max_score AS csq_score, gene_id FROM v2g_raw WHERE fpred_max_label IS NOT NULL AND fpred_max_score IS NOT NULL AND gene_id IS NOT NULL"),
    "gene_table": (("coding",), "SELECT * FROM coding"),
    "best_transcript": (("best_tr",), "SELECT * FROM best_tr"),
    "network_prepare": (
        ("string_links", "string_aliases", "known_genes"),
        """WITH_ a AS (SELECT string_id, min(gene_id) AS g FROM string_aliases WHERE starts_with(gene_id, 'ENSG') GROUP BY string_id)
        SELECT p1 AS string_id_1, p2 AS string_id_2, string_score / 1000 AS string_score, x.g AS gene_id_1, y.g AS gene_id_2, g.chrom AS gene_1_chrom, g.gene_start AS gene_1_start, g.gene_end AS gene_1_end, h.chrom AS gene_2_chrom, h.gene_start AS gene_2_start, h.gene_end AS gene_2_end
        FROM string_links JOIN a x ON p1 = x.string_id JOIN a y ON p2 = y.string_id LEFT JOIN known_genes g ON x.g = g.gene_id JOIN known_genes h ON y.g = h.gene_id WHERE string_score >= 250""",
    ),
    "name_resolution": (("resolved",), "SELECT * FROM per_gene"),
    "name_unresolved": (("resolved",), "SELECT gene_name, value FROM resolved WHERE gene_id IS NULL"),
    "trait_fixup": (("study_list", "study_traits"), "SELECT s.study_id, has_sumstats, CASE WHEN s.study_id = 'S7' THEN 'EFO_fixed' ELSE string_agg(trait, ',' ORDER BY trait) END AS traits FROM study_list s LEFT JOIN study_traits USING (study_id) GROUP BY s.study_id, has_sumstats"),
    "variant_index_filter": (("transcripts", "tags"), "SELECT DISTINCT t.chrom, t.pos, t.ref, t.alt FROM transcripts t JOIN tags c ON t.chrom = c.tag_chrom AND t.pos = c.tag_pos AND t.ref = c.tag_ref AND t.alt = c.tag_alt WHERE c.in95"),
    "locus_components": (("clusters",), "SELECT * FROM clusters"),
    "evidence_max_nbh": (("vep_f",), f"SELECT {K6}, mx AS vep_credset_max, mx_nbh AS vep_credset_max_nbh FROM vep_f"),
    "evidence_ave_nbh": (("vep_f",), f"SELECT {K6}, av AS vep_ave, av_nbh AS vep_ave_nbh FROM vep_f"),
    "evidence_features": (("vep_f",), _features("vep")),
    "dhs_features": (("dhs_f",), _features("dhs")),
    "enhancer_features": (("enh_f",), _features("enh")),
    "polyphen_features": (("pph_f",), _features("pph")),
    "tissue_evidence": (("tis_f",), _features("tis")),
    "interval_evidence": (("pch_f",), _features("pch")),
    "distance_sentinel": (("near",), "SELECT * EXCLUDE (foot) FROM sent_f"),
    "gene_density": (("near",), "SELECT * FROM density"),
    "distance_tags": (("tdist",), "SELECT * FROM tdist"),
    "distance_features": (("spine",), "SELECT * FROM spine"),
    "clpp_features": (("clpp",), "SELECT * FROM clpp"),
    "coloc_features": (("llr",), "SELECT * FROM llr"),
    "credset_size": (("csize",), "SELECT * FROM csize"),
    "study_flag": (("study_list",), "SELECT * FROM study_list"),
    "interlocus_by_study": (("context", "interactions"), _interlocus(False)),
    "interlocus_by_trait": (("context", "interactions"), _interlocus(True)),
    "interlocus_features": (("context", "interactions"), _interlocus_both()),
    "feature_matrix": (("spine", "vep_f", "dhs_f", "enh_f", "pph_f", "pch_f", "clpp", "llr", "csize", "study_list", "resolved"), MATRIX),
    "matrix_from_store": (("spine", "vep_f", "dhs_f", "enh_f", "pph_f", "pch_f", "clpp", "llr", "csize", "study_list", "resolved"), MATRIX),
    "gold_rank": (("gold",), "SELECT * FROM gold"),
    "gold_labels": (("labelled",), "SELECT * FROM labelled"),
    "training_split": (("labelled",), f"SELECT {K6}, gold_standard_status FROM labelled WHERE gold_standard_status IN (0, 1)"),
    "dropout_reports": (("labelled",), DROPOUT),
    "dropout_observed": (("labelled",), DROPOUT),
    "fold_assignment": (
        ("labelled",),
        """WITH_ counts AS (SELECT chrom, count(*) AS n FROM labelled WHERE gold_standard_status = 1 GROUP BY chrom),
        allowed AS (SELECT CAST(i AS VARCHAR) AS chrom, i FROM range(1, 23) t(i) UNION ALL SELECT 'X', 23),
        line AS (SELECT chrom, n, row_number() OVER (ORDER BY chrom) AS k FROM counts WHERE chrom IN (SELECT chrom FROM allowed)
            UNION ALL SELECT chrom, 0, (SELECT count(*) FROM counts) + row_number() OVER (ORDER BY i) FROM allowed WHERE chrom NOT IN (SELECT chrom FROM counts)),
        walk(k, chrom, fold, loads) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST([0, 0, 0, 0, 0] AS BIGINT[])
            UNION ALL SELECT q.k, q.chrom, CAST(list_position(loads, list_min(loads)) - 1 AS BIGINT), list_transform(loads, lambda x, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN x + q.n ELSE x END)
            FROM walk w JOIN line q ON q.k = w.k + 1)
        SELECT chrom, fold FROM walk WHERE chrom IS NOT NULL""",
    ),
    "heldout_scores": (("gold_loci",), f"SELECT {K5}, 1 / (1 + neglog_p + fold) AS y_proba, CAST(fold AS VARCHAR) AS fold FROM gold_loci JOIN (VALUES {', '.join(f"('{c}', {i})" for c, i in _folds().items())}) f(c, fold) ON chrom = c"),
    "confusion_report": (("scored",), CONFUSION),
    "average_precision": (("scored",), THRESHOLDS + " SELECT clf, ft, sum(p / nullif(ap, 0) * tp / (tp + fp)) AS average_precision FROM t GROUP BY clf, ft"),
    "roc_auc": (("scored",), "SELECT clf, ft, sum(w) / nullif(max(m), 0) AS roc_auc FROM (SELECT a.clf, a.ft, (CASE WHEN a.score > b.score THEN a.k * b.k WHEN a.score = b.score THEN 0.5 * a.k * b.k ELSE 0 END)::DOUBLE AS w, (sum(a.k * b.k) OVER (PARTITION BY a.clf, a.ft))::DOUBLE AS m FROM (SELECT clf, ft, score, count(*) AS k FROM scored WHERE label = 1 GROUP BY ALL) a JOIN (SELECT clf, ft, score, count(*) AS k FROM scored WHERE label <> 1 GROUP BY ALL) b ON a.clf = b.clf AND a.ft = b.ft) GROUP BY clf, ft"),
    "pr_curve": (("scored",), THRESHOLDS + " SELECT clf, ft, score, tp / (tp + fp) AS precision, tp / nullif(ap, 0) AS recall FROM t"),
    "roc_curve": (("scored",), THRESHOLDS + " SELECT clf, ft, score, fp / nullif(an, 0) AS fpr, tp / nullif(ap, 0) AS tpr FROM t"),
    "calibration": (("scored",), "SELECT clf, ft, CAST(least(floor(score * 10), 9) AS BIGINT) AS bin, count(*) AS n, avg(score) AS mean_score, avg(label) AS share_positive FROM scored GROUP BY ALL"),
    "completeness": (("predictions",), f"SELECT training_clf, training_ft, count(DISTINCT ({K6})) AS n_keys FROM predictions GROUP BY ALL HAVING count(DISTINCT ({K6})) <> (SELECT count(*) FROM (SELECT DISTINCT {K6} FROM predictions))"),
    "importance_means": (
        ("scored",),
        """WITH_ i AS (SELECT clf, ft, label, 'f' || CAST(CAST(floor(score * 10) AS BIGINT) AS VARCHAR) AS feature, avg(score) AS importance FROM scored GROUP BY ALL), m AS (SELECT clf, ft, feature, avg(importance) AS mean_importance FROM i GROUP BY ALL)
        SELECT *, row_number() OVER (PARTITION BY clf, ft ORDER BY mean_importance DESC, feature) AS place FROM m""",
    ),
    "parameter_usage": ((), "SELECT 'depth' AS parameter, CAST(p_size AS VARCHAR) AS value, count(*) AS n FROM part GROUP BY p_size UNION ALL SELECT 'type', p_type, count(*) FROM part GROUP BY p_type"),
    "score_pivot": (
        ("predictions",),
        f"""SELECT {K6}, training_clf, training_gs, training_fold, {', '.join(f"sum(y_proba) FILTER (WHERE training_ft = '{f}') AS y_proba_{f}" for f in ('full_model', 'dist_foot', 'dist_tss'))}
        FROM predictions WHERE study_id NOT IN ('S3', 'S11') AND training_clf = 'gbt' AND training_gs = 'high_medium' GROUP BY ALL""",
    ),
}


def build(name: str) -> str:
    reads, sql = QUERIES[name]
    views: list[str] = []
    steps: list[str] = []

    def visit(x: str) -> None:
        if x in STEPS:
            if x not in steps:
                for d in STEPS[x][0]:
                    visit(d)
                steps.append(x)
        elif x in VIEWS and x not in views:
            views.append(x)

    for r in reads:
        visit(r)
    parts = ([duck_ctes(views)] if views else []) + [STEPS[x][1] for x in steps]
    body = sql
    if sql.startswith("WITH_"):
        # the query's own CTEs end where its last SELECT at nesting level 0 begins
        own, body = _cut(sql.removeprefix("WITH_").strip())
        parts.append(own)
    text = f"WITH RECURSIVE {', '.join(parts)}, result AS ({body})" if parts else f"WITH result AS ({body})"
    # counts are bigint on both sides, and doubles are rounded to 6 places
    return f"{text} SELECT {_final(name)} FROM result"


def _cut(sql: str) -> tuple[str, str]:
    depth = 0
    for i, ch in enumerate(sql):
        depth += (ch == "(") - (ch == ")")
        if depth == 0 and sql.startswith("SELECT", i):
            return sql[:i].strip(), sql[i:]
    raise ValueError(sql[:80])


DISTANCES = "dist_foot_sentinel dist_foot_sentinel_nbh dist_tss_sentinel dist_tss_sentinel_nbh"
TAG_DISTANCES = " ".join(f"dist_{d}_{a}{n}" for d in ("foot", "tss") for a in ("min", "ave") for n in ("", "_nbh"))
CLPP = " ".join(f"{t}_pics_clpp_{x}" for t in ("eqtl", "sqtl", "pqtl") for x in ("max", "max_neglogp", "max_nhb"))
LLR = " ".join(f"{t}_coloc_llr_{x}" for t in ("eqtl", "sqtl", "pqtl") for x in ("max", "max_neglogp", "max_nbh"))
FAMILY = {p: names.replace(",", "") for p, names in NAMES.items()}
SUMS = "{0}_unweighted {0}_target_weighted {0}_loci_weighted {0}_both_weighted"

#: Double columns of each query, rounded to 6 places.
ROUND = {
    "scan_project_filter": "net", "neglog_p": "neglog_p", "credset_unify": "fm_postprob pics_postprob combined_postprob", "qtl_prepare": "postprob qtl_neglog_p",
    "coloc_prepare": "coloc_log2_h4_h3 coloc_h4", "mixed_split_interval": "interval_score", "mixed_split_consequence": "csq_score", "best_transcript": "polyphen_score",
    "network_prepare": "string_score", "name_resolution": "value", "name_unresolved": "value", "evidence_max_nbh": "vep_credset_max vep_credset_max_nbh",
    "evidence_ave_nbh": "vep_ave vep_ave_nbh", "evidence_features": FAMILY["vep"], "dhs_features": FAMILY["dhs"], "enhancer_features": FAMILY["enh"],
    "polyphen_features": FAMILY["pph"], "tissue_evidence": FAMILY["tis"], "interval_evidence": FAMILY["pch"], "distance_sentinel": DISTANCES, "distance_tags": TAG_DISTANCES,
    "distance_features": f"{DISTANCES} {TAG_DISTANCES}", "clpp_features": CLPP, "coloc_features": LLR, "interlocus_by_study": SUMS.format("interlocus_study"),
    "interlocus_by_trait": SUMS.format("interlocus_trait"), "interlocus_features": f"{SUMS.format('interlocus_study')} {SUMS.format('interlocus_trait')}", "gold_rank": "neglog_p", "heldout_scores": "y_proba",
    "feature_matrix": " ".join([DISTANCES, TAG_DISTANCES, *[FAMILY[p] for p in ("vep", "dhs", "enh", "pph", "pch")], CLPP, LLR, "proteinAttenuation"]),
    "matrix_from_store": " ".join([DISTANCES, TAG_DISTANCES, *[FAMILY[p] for p in ("vep", "dhs", "enh", "pph", "pch")], CLPP, LLR, "proteinAttenuation"]),
    "confusion_report": "accuracy precision recall tpr tnr fpr fnr fdr f1 balanced_accuracy", "average_precision": "average_precision", "roc_auc": "roc_auc",
    "pr_curve": "score precision recall", "roc_curve": "score fpr tpr", "calibration": "mean_score share_positive", "importance_means": "mean_importance",
    "score_pivot": "y_proba_full_model y_proba_dist_foot y_proba_dist_tss",
}
#: Integer columns that are not bigint yet.
WIDEN = {
    "scan_project_filter": "line", "gold_rank": "gs_confidence_num", "gold_labels": "gold_standard_status gs_confidence_num", "training_split": "gold_standard_status",
    "confusion_report": "tp fp tn fn support",
}


def _final(name: str) -> str:
    changed = [f'round("{c}" + {NUDGE}, 6) AS "{c}"' for c in ROUND.get(name, "").split()] + [f"CAST({c} AS BIGINT) AS {c}" for c in WIDEN.get(name, "").split()]
    return f"* REPLACE ({', '.join(changed)})" if changed else "*"


def all_sql() -> dict[str, str]:
    return {name: build(name) for name in QUERIES}
