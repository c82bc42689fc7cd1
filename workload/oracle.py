"""The same queries as plain SQL over the benchmark tables, written apart from the engine."""

from __future__ import annotations

import re


def _chr(k):
    return f"CASE WHEN {k}%40 BETWEEN 5 AND 12 THEN 'chrX' WHEN {k}%40 IN (13,14) THEN 'chrY' ELSE 'chr'||(1+({k}%40)%22) END"


def _ref(k):
    return f"CASE WHEN {k}%10=1 THEN '-' ELSE 'A' END"


def _alt(k):
    return f"CASE WHEN {k}%10=0 THEN '-' WHEN {k}%10=1 THEN 'T' ELSE 'G' END"


def _variant(k):
    return f"{_chr(k)} AS chr, 1000+10*{k} AS start, {_ref(k)} AS ref, {_alt(k)} AS alt"


def _ratio(n, d):
    return f"CAST({n} AS DOUBLE)/CAST({d} AS DOUBLE)"


KEY = "chr||':'||start||'_'||ref||'>'||alt"
GT = """CASE WHEN l_linenumber=7 THEN CASE WHEN l_linestatus='F' THEN '1' ELSE '.' END
  ELSE CASE l_returnflag||l_linestatus WHEN 'AF' THEN '0/1' WHEN 'AO' THEN '1/1' WHEN 'NF' THEN '0|1'
  WHEN 'NO' THEN '0/0' WHEN 'RF' THEN './.' WHEN 'RO' THEN '1/2' END END
  || CASE WHEN l_discount=0 THEN '' ELSE ':'||CAST(l_quantity AS INT)||','||l_linenumber||':'||(CAST(l_quantity AS INT)+l_linenumber) END"""
CLASS = """CASE WHEN gt IS NULL THEN NULL WHEN substr(gt,1,1)='.' OR substr(gt,3,1)='.' THEN 'miss'
  WHEN substr(gt,1,1)<>substr(gt,3,1) THEN 'het' WHEN substr(gt,1,1)='0' THEN 'ref' ELSE 'hom' END"""
ADJUSTED = """CASE WHEN sex=1 AND is_xy AND base='hom' THEN 'hem' WHEN sex=1 AND is_xy AND base='het' THEN 'ref'
  WHEN sex=2 AND chr IN ('Y','chrY') THEN 'ref' WHEN sex=2 AND is_xy AND base IN ('het','hom') THEN base||'_female' ELSE base END"""
ORD = "l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_suppkey, gt"
NORM = "CASE WHEN phred IS NULL THEN NULL WHEN phred<0 THEN 0.0::DOUBLE WHEN phred>62 THEN 62.0::DOUBLE ELSE phred END/62.0::DOUBLE"
LABEL = """CASE geno WHEN 'het' THEN 'DOM-het' WHEN 'het_female' THEN 'X-linked-het' WHEN 'hom' THEN 'REC-hom'
  WHEN 'hom_female' THEN 'X-linked-hom' WHEN 'chet' THEN 'REC-chet' WHEN 'chet_female' THEN 'X-linked-chet'
  WHEN 'hem' THEN CASE WHEN chr IN ('X','chrX') THEN 'X-linked-hem' WHEN chr IN ('Y','chrY') THEN 'Y-linked-hem' END END"""
DESCRIBED = "func, exonic_func, aa_change, gene_detail, af, af_afr, af_nfe, clnsig, clndn"
REASON = """CASE WHEN regexp_matches(gene,'^(HLA|MUC|KRT|TRBV)') THEN ',blacklist' ELSE '' END
  || CASE WHEN gene NOT IN (SELECT gene FROM lookup) THEN ',not_in_lookup' ELSE '' END
  || CASE WHEN func NOT LIKE '%splic%' AND exonic_func IS NULL THEN ',non_coding' ELSE '' END"""
AF_REASON = "|| CASE WHEN af IS NULL AND (coalesce(kg,0)>0.05 OR coalesce(esp,0)>0.05) THEN ',af_discrepancy' ELSE '' END"


def _gene(k):
    return f"""CASE {k}%40 WHEN 0 THEN 'HLA-A' WHEN 1 THEN 'MUC1' WHEN 2 THEN 'KRT5' WHEN 3 THEN 'TRBV9' ELSE 'GENE'||({k}%40) END
  || CASE WHEN {k}%17=0 THEN ';GENE'||(({k}%40+1)%40) ELSE '' END"""


K = "p_partkey"
CTES = {
    "site0": f"""SELECT {K} AS k, {_variant(K)}, 1000+10*{K} AS "end",
  CASE WHEN {K}%7=0 THEN 'splicing' WHEN {K}%7=1 THEN 'intronic' ELSE 'exonic' END AS func,
  {_gene(K)} AS genes, p_type AS gene_detail,
  CASE WHEN {K}%7<2 THEN NULL WHEN {K}%10=0 THEN 'frameshift deletion' WHEN {K}%10=1 THEN 'frameshift insertion'
   WHEN {K}%10=2 THEN 'nonframeshift deletion' WHEN {K}%3=0 THEN 'synonymous SNV' ELSE 'nonsynonymous SNV' END AS exonic_func,
  p_brand AS aa_change, CASE WHEN {K}%5<>0 THEN {_ratio(f'({K}%100)', 1000)} END AS af,
  CASE WHEN {K}%13<>0 THEN {_ratio(f'({K}%11)', 100)} END AS kg, CASE WHEN {K}%11<>0 THEN {_ratio(f'({K}%9)', 100)} END AS esp,
  CASE WHEN {K}%29=0 THEN NULL WHEN {K}%31=0 THEN CAST(-1.5 AS DOUBLE) ELSE {_ratio(f'((37*{K})%700)', 10)} END AS phred,
  CASE WHEN {K}%6=0 THEN 'Benign' END AS clnsig, p_name AS clndn FROM part""",
    "site": "SELECT * EXCLUDE (genes), af AS af_afr, af AS af_nfe, af AS exac, phred/CAST(10 AS DOUBLE) AS raw_score, unnest(string_split(genes,';')) AS gene FROM site0",
    "call": f"""SELECT 'S'||o_custkey AS iid, {_variant('l_partkey')},
  CASE WHEN l_tax>=0.08 THEN 'LowQual' WHEN l_tax=0 THEN '.' ELSE 'PASS' END AS filter, {GT} AS gt,
  l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_suppkey FROM lineitem JOIN orders ON l_orderkey=o_orderkey""",
    "ped": """SELECT 'F'||c_nationkey AS fam_id, 'S'||c_custkey AS iid, '0' AS pat_id, '0' AS mat_id,
  CAST(CASE WHEN c_custkey%20=0 THEN 0 ELSE 1+c_custkey%2 END AS INT) AS sex,
  CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 2 WHEN c_mktsegment='HOUSEHOLD' THEN 0 ELSE 1 END AS status,
  CASE r_name WHEN 'AFRICA' THEN 'AFR' WHEN 'EUROPE' THEN 'NFE' ELSE 'ALL' END AS eth
  FROM customer JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "lookup": "SELECT DISTINCT gene FROM site WHERE gene<>'GENE4'",
    "xy": "SELECT DISTINCT gene FROM site WHERE gene LIKE 'GENE%' AND CAST(substr(gene,5) AS INT) BETWEEN 5 AND 15",
    "nullgene": "SELECT gene, coalesce(TRY_CAST(regexp_extract(gene,'[0-9]+') AS INT),0) AS n FROM lookup WHERE gene<>'GENE20'",
    "weight": """SELECT model, eth, w*e AS weight FROM (VALUES ('het',1000),('chet',500),('hom',100),('hem',10)) a(model,w),
  (VALUES ('ALL',3),('AFR',2),('NFE',1)) b(eth,e)""",
    "bin": f"""SELECT phred, CAST(count(*) AS INT)+1 AS j FROM (SELECT DISTINCT phred, {NORM} AS x FROM
  (SELECT phred FROM site0 UNION SELECT phred FROM indel UNION SELECT CAST(30 AS DOUBLE)) WHERE phred IS NOT NULL), range(1401) r(b)
  WHERE b*7.14285e-4<=x GROUP BY phred""",
    "indel0": f"""SELECT {K} AS k, substr({_chr(K)},4) AS chr, 1000+10*{K}-CASE WHEN {K}%10=0 THEN 1 ELSE 0 END AS start,
  CASE WHEN {K}%10=0 THEN 'TA' ELSE 'A' END AS ref, CASE WHEN {K}%10=0 THEN 'T' ELSE 'AT' END AS alt,
  {_ratio(f'((13*{K})%600)', 10)} AS phred, {_ratio(f'((13*{K})%600)', 10)}/CAST(10 AS DOUBLE) AS raw_score
  FROM part, range(2) WHERE {K}%10 IN (0,1) AND {K}%3=0""",
    "indel": """SELECT DISTINCT 'chr'||chr AS chr, CASE WHEN ref='TA' THEN start+1 ELSE start END AS start,
  CASE WHEN ref='TA' THEN 'A' ELSE '-' END AS ref, CASE WHEN alt='AT' THEN 'T' ELSE '-' END AS alt, raw_score, phred FROM indel0""",
    "joined": f"""SELECT c.iid, {KEY.replace('chr','c.chr',1).replace('||start','||c.start').replace('||ref','||c.ref').replace('||alt','||c.alt')} AS key, c.gt, c.filter,
  s.*, p.fam_id, p.sex, p.status, p.eth, s.gene IN (SELECT gene FROM xy) AS is_xy,
  row_number() OVER (PARTITION BY c.iid, c.chr, c.start, c.ref, c.alt, s.gene ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_suppkey, c.gt) AS rn
  FROM call c JOIN site s ON c.chr=s.chr AND c.start=s.start AND c.ref=s.ref AND c.alt=s.alt
  JOIN ped p ON c.iid=p.iid WHERE p.sex IN (1,2)""",
    "based": f"SELECT *, {CLASS} AS base FROM joined WHERE rn=1",
    "raw": f"SELECT *, {ADJUSTED} AS geno FROM based",
    "reasoned": f"SELECT *, {REASON} || CASE WHEN phred IS NULL THEN ',unscored' ELSE '' END AS why FROM raw",
    "clean": f"SELECT *, {NORM} AS norm, (func LIKE '%splic%') AS splice FROM reasoned WHERE why=''",
    "ranked": """SELECT *, CASE WHEN geno LIKE 'het%' THEN 'het' WHEN geno LIKE 'hom%' THEN 'hom' ELSE 'hem' END AS zyg,
  row_number() OVER (PARTITION BY iid, gene, left(geno,3) ORDER BY norm DESC, splice DESC, key) AS rk,
  count(*) OVER (PARTITION BY iid, gene, left(geno,3)) AS cnt FROM clean
  WHERE geno IN ('het','hom','hem','het_female','hom_female')""",
    "priced": """SELECT r.*, CAST((1402-j)*w.weight*(1+n.n%7) AS DOUBLE)/CAST(29421000 AS DOUBLE) AS prob,
  CAST((1402-j)*x.weight*(1+n.n%7) AS DOUBLE)/CAST(29421000 AS DOUBLE) AS chet_p
  FROM ranked r JOIN bin b ON b.phred=r.phred JOIN weight w ON w.eth=r.eth AND w.model=r.zyg
  JOIN weight x ON x.eth=r.eth AND x.model='chet' LEFT JOIN nullgene n ON n.gene=r.gene""",
    "single": f"SELECT *, {LABEL} AS dz_model FROM priced",
    "pair0": """SELECT * REPLACE (replace(geno,'het','chet') AS geno) FROM priced WHERE zyg='het' AND cnt>=2""",
    "pairs": f"SELECT *, {LABEL} AS dz_model, max(CASE WHEN rk=2 THEN chet_p END) OVER (PARTITION BY iid, gene) AS pair_p FROM pair0",
    "depth": """SELECT *, nullif(split_part(split_part(gt,':',2),',',2),'') AS alt_read, nullif(split_part(gt,':',3),'') AS total_read FROM call""",
    "gtwide": f"SELECT l_partkey, s_nationkey, min({GT}) AS gt FROM lineitem JOIN supplier ON l_suppkey=s_suppkey GROUP BY ALL",
    "vcf": f"""SELECT {K} AS k, {_chr(K)} AS chrom, 1000+10*{K}-CASE WHEN {K}%10=0 THEN 1 ELSE 0 END AS pos,
  CASE WHEN {K}%10=0 THEN 'TA' ELSE 'A' END AS ref,
  CASE WHEN {K}%10=0 THEN 'T' WHEN {K}%10=1 THEN 'AT' WHEN {K}%23=0 THEN 'G,C' ELSE 'G' END AS alt, 'AC='||({K}%7) AS ac FROM part""",
    "vcfgt": "SELECT v.*, 'N'||s_nationkey AS iid, gt FROM vcf v JOIN gtwide ON l_partkey=k WHERE regexp_matches(split_part(gt,':',1),'[1-9]')",
}


def _cnv(segments, kind):
    c = "c_custkey"
    geno = f"CASE WHEN {c}%3=0 THEN 'hom' ELSE 'het' END" if kind == "del" else "'het'"
    what = "deletion" if kind == "del" else "insertion"
    return f"""SELECT {c} AS ck, 'S'||{c} AS iid, {_chr(c)} AS chr, 500000+{c} AS start, 'N' AS ref, '0' AS alt, 'GENE'||({c}%40) AS gene,
  'exonic' AS func, 'frameshift {what}' AS exonic_func, CAST(30 AS DOUBLE) AS phred, 'PASS' AS filter,
  CAST({c}%7 AS VARCHAR) AS alt_read, CAST({c}%11 AS VARCHAR) AS total_read, {geno} AS geno0 FROM customer WHERE c_mktsegment IN {segments}"""


CTES["del"] = _cnv("('BUILDING','FURNITURE')", "del")
CTES["dup"] = _cnv("('MACHINERY','FURNITURE')", "dup")
CTES["cnv0"] = "SELECT *, 0 AS tab FROM del UNION ALL SELECT *, 1 AS tab FROM dup"
CTES["cnv"] = f"""SELECT *, CASE WHEN sex=1 AND is_xy THEN 'hem' WHEN sex=2 AND chr='chrY' THEN 'ref'
  WHEN sex=2 AND is_xy THEN geno0||'_female' ELSE geno0 END AS geno FROM
  (SELECT c.*, {KEY} AS key, p.fam_id, p.sex, p.status, p.eth, gene IN (SELECT gene FROM xy) AS is_xy FROM cnv0 c JOIN ped p USING (iid) WHERE p.sex IN (1,2))"""


def _full(profile):
    """CTEs of a run with indel scores and copy-number calls."""
    pattern = "exonic_func LIKE '%shift%'" if profile == "cadd13_v13" else "exonic_func LIKE 'frameshift%'"
    strict = profile != "cadd16"
    indels = "indel" if not strict else "indelraw"
    ctes = {
        "indelraw": CTES["indel"].replace("'chr'||chr AS chr", "chr"),
        "allrows": f"""SELECT iid, key, chr, start, ref, alt, gene, fam_id, sex, status, eth, geno, filter, func, exonic_func, aa_change, gene_detail,
  af, af_afr, af_nfe, exac, kg, esp, raw_score, phred, clnsig, clndn, gt, false AS is_cnv, 0 AS tab, 0 AS ck, NULL AS c_alt, NULL AS c_tot FROM raw
  UNION ALL SELECT iid, key, chr, start, ref, alt, gene, fam_id, sex, status, eth, geno, filter, func, exonic_func, NULL, NULL,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, phred, NULL, NULL, NULL, true, tab, ck, alt_read, total_read FROM cnv""",
        "shown": """SELECT *, CASE WHEN is_cnv THEN c_alt ELSE nullif(split_part(split_part(gt,':',2),',',2),'') END AS alt_read,
  CASE WHEN is_cnv THEN c_tot ELSE nullif(split_part(gt,':',3),'') END AS total_read FROM allrows""",
        "why0": f"SELECT *, {REASON} {AF_REASON if strict else ''} || {'''CASE WHEN filter IN ('PASS','.') THEN '' ELSE ',filter' END''' if strict else "''"} AS why0, coalesce({pattern}, false) AS rescored FROM shown",
        "scored": f"""SELECT w.* REPLACE (CASE WHEN w.rescored THEN i.phred ELSE w.phred END AS phred), w.phred AS own FROM why0 w
  LEFT JOIN {indels} i ON w.rescored AND w.chr=i.chr AND w.start=i.start AND w.ref=i.ref AND w.alt=i.alt""",
        "fwhy": "SELECT *, why0 || CASE WHEN phred IS NULL THEN ',unscored' ELSE '' END AS why FROM scored",
        "fclean": f"SELECT *, {NORM} AS norm, (func LIKE '%splic%') AS splice FROM fwhy WHERE why=''",
        "franked": """SELECT *, left(geno,3) AS zyg,
  row_number() OVER (PARTITION BY iid, gene, left(geno,3) ORDER BY norm DESC, rescored, splice DESC, is_cnv,
    CASE WHEN NOT rescored THEN key ELSE '' END, chr, start, ref, alt, tab, ck) AS rk,
  count(*) OVER (PARTITION BY iid, gene, left(geno,3)) AS cnt FROM fclean WHERE geno IN ('het','hom','hem','het_female','hom_female')""",
        "fpriced": CTES["priced"].replace("FROM ranked", "FROM franked"),
        "fsingle": CTES["single"].replace("FROM priced", "FROM fpriced"),
        "fpair0": CTES["pair0"].replace("FROM priced", "FROM fpriced"),
        "fpairs": CTES["pairs"].replace("FROM pair0", "FROM fpair0"),
    }
    return ctes


def sql(body: str, extra: dict | None = None) -> str:
    """``body`` under the CTEs it needs, in order of need."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def need(text):
        words = set(re.findall(r"(?:FROM|JOIN|UNION SELECT phred FROM)\s+(\w+)", text))
        for name in known:
            if name in words and name not in order:
                need(known[name])
                if name not in order:
                    order.append(name)

    need(body)
    head = ",\n".join(f"{n} AS ({known[n]})" for n in order)
    return f"WITH {head}\n{body}" if head else body


V = "chr, start, ref, alt"
A = f"{V}, func, gene, exonic_func, phred"
CALLED = "iid, key, gene"
READS = "nullif(split_part(split_part(gt,':',2),',',2),'') AS alt_read, nullif(split_part(gt,':',3),'') AS total_read"
CLAMPED = "CASE WHEN phred<0 THEN 0 WHEN phred>62 THEN 62 ELSE phred END AS phred"
OUT = f"fam_id, iid, key, {V}, {READS}, gene, {DESCRIBED}, {CLAMPED}, geno, dz_model"
WORST = f"""SELECT {OUT}, prob FROM single WHERE rk=1
UNION ALL SELECT {OUT}, pair_p AS prob FROM pairs WHERE rk<=2"""
SCAN_CNV = "SELECT iid, {v}, gene, func, phred, '{t}' AS type, alt_read, total_read, geno0 AS geno FROM {n}"
GENE_COLUMNS = ", ".join(
    f"('{p}','{b}','Gene.wgEncodeGencodeBasicV{v}')"
    for p, b, v in (
        ("cadd16", "hg38", 35),
        ("cadd16", "hg19", 19),
        ("cadd13_v14", "hg38", 20),
        ("cadd13_v14", "hg19", 19),
        ("cadd13_v13", "hg38", 20),
        ("cadd13_v13", "hg19", 19),
    )
)


def _full_ranked(profile, report_all=False):
    af = ", exac, kg, esp" if profile != "cadd16" else ""
    out = f"fam_id, iid, key, {V}, alt_read, total_read, gene, {DESCRIBED}{af}, {CLAMPED}, geno, dz_model"
    if report_all:
        body = f"SELECT {out}, prob FROM fsingle UNION ALL SELECT {out}, chet_p AS prob FROM fpairs"
    else:
        body = f"SELECT {out}, prob FROM fsingle WHERE rk=1 UNION ALL SELECT {out}, pair_p AS prob FROM fpairs WHERE rk<=2"
    return sql(body, _full(profile))


def oracle_sql() -> dict[str, str]:
    dropped = f"fam_id, iid, key, {V}, {READS}, gene, {DESCRIBED}, phred, geno, substr(why,2) AS drop_reason"
    full_dropped = f"fam_id, iid, key, {V}, alt_read, total_read, gene, {DESCRIBED}, exac, kg, esp, own AS phred, geno"
    reason13 = f"{REASON} {AF_REASON} || CASE WHEN filter IN ('PASS','.') THEN '' ELSE ',filter' END"
    model = f"{CALLED}, geno, {CLAMPED}, dz_model"
    trimmed = f"CASE WHEN ref='TA' THEN start+1 ELSE start END AS start, CASE WHEN ref='TA' THEN 'A' ELSE '-' END AS ref, CASE WHEN alt='AT' THEN 'T' ELSE '-' END AS alt"
    variant = f"""chrom AS chr, CASE WHEN length(ref)>1 THEN pos+1 ELSE pos END AS start, CASE WHEN length(ref)>1 THEN pos+1 ELSE pos END AS "end",
  CASE WHEN length(ref)>1 THEN substr(ref,2) WHEN length(alt)>1 AND alt<>'G,C' THEN '-' ELSE ref END AS ref,
  unnest(CASE WHEN alt='G,C' THEN ['G','C'] WHEN length(ref)>1 THEN ['-'] WHEN alt='AT' THEN ['T'] ELSE [alt] END) AS alt"""
    rescored = """SELECT s.chr, s.start, s.ref, s.alt, gene, exonic_func, coalesce({p},false) AS rescored,
  CASE WHEN coalesce({p},false) THEN i.raw_score ELSE s.raw_score END AS raw_score,
  CASE WHEN coalesce({p},false) THEN i.phred ELSE s.phred END AS phred FROM site s LEFT JOIN {t} i
  ON {p} AND s.chr=i.chr AND s.start=i.start AND s.ref=i.ref AND s.alt=i.alt"""
    from_vcf = _full("cadd16") | {
        "ped": """SELECT 'R'||n_regionkey AS fam_id, 'N'||n_nationkey AS iid, '0' AS pat_id, '0' AS mat_id, CAST(1+n_nationkey%2 AS INT) AS sex,
  CAST(1+n_nationkey%3%2 AS INT) AS status, CASE r_name WHEN 'AFRICA' THEN 'AFR' WHEN 'EUROPE' THEN 'NFE' ELSE 'ALL' END AS eth
  FROM nation JOIN region ON n_regionkey=r_regionkey""",
        "call": f"""SELECT iid, chr, start, ref, alt, 'PASS' AS filter, gt, 0 AS l_orderkey, 0 AS l_linenumber, 0 AS l_extendedprice, 0 AS l_shipdate, 0 AS l_suppkey
  FROM (SELECT iid, {variant}, unnest(CASE WHEN alt='G,C' THEN [1,2] ELSE [1] END) AS allele, gt FROM vcfgt)
  WHERE list_contains(string_split(replace(split_part(gt,':',1),'|','/'),'/'), CAST(allele AS VARCHAR))""",
        "cnv": CTES["cnv"] + " WHERE false",
    }
    shown = f"fam_id, iid, key, {V}, alt_read, total_read, gene, {DESCRIBED}, {CLAMPED}, geno, dz_model"
    from_vcf_body = f"SELECT {shown}, prob FROM fsingle WHERE rk=1 UNION ALL SELECT {shown}, pair_p AS prob FROM fpairs WHERE rk<=2"
    return {
        "vcf_sites": sql("SELECT chrom, pos, '.' AS vcf_id, ref, alt, '50' AS qual, 'PASS' AS filter, 'AN=50;'||ac||';DB' AS info FROM vcf"),
        "vcf_samples": "SELECT 'N'||n_nationkey AS iid, CAST(row_number() OVER (ORDER BY n_nationkey)-1 AS INT) AS sample_pos FROM nation",
        "scan_annotations": sql("""SELECT chr, start, "end", ref, alt, genes AS gene, func, exonic_func, aa_change, gene_detail, af, af AS af_afr, af AS af_nfe,
  phred/CAST(10 AS DOUBLE) AS raw_score, CASE WHEN k%41<>0 THEN phred END AS phred, clnsig, clndn FROM site0"""),
        "scan_calls": sql(f"SELECT iid, {V}, '50' AS qual, filter, 'GT:AD:DP' AS format, gt FROM call"),
        "scan_pedigree": sql("SELECT * FROM ped"),
        "scan_pedigree_wide": sql("SELECT * FROM ped"),
        "scan_gene_lists": sql("SELECT DISTINCT gene FROM site"),
        "scan_null_tables": sql("""SELECT model, eth, gene, 1401 AS n_bins, CAST(1400*weight*(1+n%7) AS DOUBLE)/CAST(29421000 AS DOUBLE) AS p_max,
  CAST(0 AS DOUBLE) AS p_min, CAST(700*weight*(1+n%7) AS DOUBLE)/CAST(29421000 AS DOUBLE) AS p_700 FROM nullgene CROSS JOIN (SELECT * FROM weight)"""),
        "scan_indel_scores": sql(f"SELECT {V}, raw_score, phred FROM indel0"),
        "scan_cnv_del": sql(SCAN_CNV.format(v=V, t="DEL", n="del")),
        "scan_cnv_dup": sql(SCAN_CNV.format(v=V, t="DUP", n="dup")),
        "missing_sources": sql(
            """SELECT source FROM (SELECT unnest(['1000g2015aug_all','cadd13','esp6500siv2_all','exac03','gene_model','gene_model_mrna','gnomad_exome','clinvar']) AS source,
  unnest([count(kg), count(phred), count(esp), count(af), count(genes), count(aa_change), count(af), count(*) FILTER (clnsig='Pathogenic')]) AS n FROM site0) WHERE n=0"""
        ),
        "samples_not_in_vcf": "SELECT 'N'||(c_custkey%40) AS iid, c_name AS fam_id FROM customer WHERE c_custkey%40 NOT IN (SELECT n_nationkey FROM nation)",
        "rejected_people": sql("SELECT iid, 'sex' AS reason FROM ped WHERE sex=0 UNION ALL SELECT DISTINCT iid, 'missing' FROM call WHERE iid NOT IN (SELECT iid FROM ped)"),
        "pending": sql("SELECT fam_id, iid FROM ped WHERE iid NOT IN (SELECT 'S'||o_custkey FROM orders WHERE o_orderpriority='1-URGENT')"),
        "variant_key_of_calls": sql(f"SELECT iid, {KEY} AS key, gt FROM call"),
        "resolve_build": sql(f"SELECT gene, n_sites, profile, build, gene_column FROM (SELECT gene, count(*) AS n_sites FROM site GROUP BY gene), (VALUES {GENE_COLUMNS}) t(profile,build,gene_column)"),
        "read_depths": sql(f"SELECT iid, {V}, gt, alt_read, total_read FROM depth"),
        "genotype_classes": sql(f"SELECT iid, {V}, gt, {CLASS} AS geno, CASE split_part(gt,':',1) WHEN '.' THEN 'miss' WHEN './.' THEN 'miss' WHEN '0/0' THEN 'ref' WHEN '1/1' THEN 'hom' WHEN '1' THEN 'hom' ELSE 'het' END AS geno_strict FROM call"),
        "sex_adjust": sql(f"SELECT {CALLED}, sex, is_xy, geno FROM raw"),
        "ancestry_group": sql("SELECT iid, eth, CASE eth WHEN 'ALL' THEN '' ELSE '_'||eth END AS suffix FROM ped"),
        "score_bins": sql(f"SELECT {V}, {NORM.replace('phred','s.phred')} AS norm, j AS bin FROM site0 s LEFT JOIN bin b ON s.phred=b.phred"),
        "indel_left_trim": sql(f"SELECT chr, {trimmed}, phred FROM indel0"),
        "harmonize_contigs": sql("SELECT 'chr'||chr AS chr, start, ref, alt, phred FROM indel0"),
        "indel_needs_trim": sql(f"SELECT 'anchored' AS form, chr, {trimmed} FROM indel0 UNION ALL SELECT 'dashed', chr, {trimmed} FROM indel0"),
        "cnv_genotype": sql(f"SELECT iid, {V}, gene, geno0 AS geno FROM del"),
        "cnv_sex_adjust": sql(f"SELECT iid, {V}, gene, exonic_func, filter, sex, geno FROM cnv"),
        "model_label": sql(f"SELECT {CALLED}, geno, {LABEL} AS dz_model FROM raw"),
        "info_keep_ac": sql("SELECT chrom, pos, ref, alt, ac AS info FROM vcf"),
        "vcf_to_variant": sql(f"SELECT {variant} FROM vcf"),
        "drop_blacklist": sql(f"SELECT {A} FROM site WHERE NOT regexp_matches(gene,'^(HLA|MUC|KRT|TRBV)')"),
        "drop_af_discrepancy": sql(f"SELECT {A}, af, kg, esp FROM site WHERE NOT (af IS NULL AND (coalesce(kg,0)>0.05 OR coalesce(esp,0)>0.05))"),
        "keep_lookup_genes": sql(f"SELECT {A} FROM site WHERE gene IN (SELECT gene FROM lookup)"),
        "drop_missing_geno": sql(f"SELECT iid, {V}, status, geno FROM (SELECT c.*, status, CASE WHEN gt NOT LIKE '.%' THEN {CLASS} END AS geno FROM call c JOIN ped USING (iid) WHERE sex IN (1,2)) WHERE geno IS NOT NULL OR status=0"),
        "keep_coding_splice": sql(f"SELECT {A} FROM site WHERE func LIKE '%splic%' OR exonic_func IS NOT NULL"),
        "keep_scored": sql(f"SELECT {A} FROM site WHERE phred IS NOT NULL"),
        "keep_pass": sql(f"SELECT iid, {V}, filter, gt FROM call WHERE filter IN ('PASS','.')"),
        "clean_variants": sql(f"SELECT {CALLED}, geno, filter FROM raw WHERE {reason13}=''"),
        "drop_reasons": sql(f"""SELECT {CALLED}, substr(why,2) AS drop_reason, bool_or(why='') OVER (PARTITION BY iid, key) AS key_kept
  FROM (SELECT *, {reason13} || CASE WHEN phred IS NULL THEN ',unscored' ELSE '' END AS why FROM raw)"""),
        "carriers": sql(f"SELECT iid, {V}, gt FROM call WHERE regexp_matches(split_part(gt,':',1),'[1-9]')"),
        "annotations_of_carriers": sql(f"SELECT {A.replace('gene','genes AS gene',1)} FROM site0 WHERE k IN (SELECT l_partkey FROM (SELECT l_partkey, {GT} AS gt FROM lineitem JOIN orders ON l_orderkey=o_orderkey) WHERE regexp_matches(split_part(gt,':',1),'[1-9]'))"),
        "join_calls_annotations": sql("SELECT iid, s.chr, s.start, s.ref, s.alt, gene, func, phred, filter, gt FROM call c JOIN site s ON c.chr=s.chr AND c.start=s.start AND c.ref=s.ref AND c.alt=s.alt"),
        "dedupe_key_gene": sql(f"SELECT {CALLED}, gt, filter, phred FROM raw"),
        "xy_flag": sql(f"SELECT {V}, gene, gene IN (SELECT gene FROM xy) AS is_xy FROM site"),
        "join_pedigree": sql(f"SELECT iid, {V}, gt, fam_id, sex, status, eth FROM call JOIN ped USING (iid) WHERE sex IN (1,2)"),
        "rescore_indels": sql(rescored.format(p="exonic_func LIKE 'frameshift%'", t="indel")),
        "rescore_indels_v13": sql(rescored.format(p="exonic_func LIKE '%shift%'", t="indelraw"), _full("cadd13_v13")),
        "null_cells": sql(f"SELECT {CALLED}, eth, {CLAMPED}, prob FROM priced WHERE zyg='het'"),
        "annotate_site_sources": sql("""SELECT chr, start, "end", ref, alt, af, af AS exac, esp, kg, clnsig, CASE WHEN clnsig IS NOT NULL THEN clndn END AS clndn FROM site0"""),
        "annotate_site_scores": sql(f"SELECT {V}, genes AS gene, CASE WHEN phred>=0 THEN phred/CAST(10 AS DOUBLE) END AS raw_score, CASE WHEN phred>=0 THEN phred END AS phred FROM site0"),
        "annotate_from_genome": sql(f"""SELECT {V}, genes AS gene, x/CAST(10 AS DOUBLE) AS raw_score, x AS phred FROM
  (SELECT s.*, {_ratio("((11*o_orderkey)%600)", 10)} AS x FROM site0 s LEFT JOIN orders ON o_orderkey=k)"""),
        "split_genes": sql(f"SELECT {A} FROM site"),
        "unpivot_genotypes": sql("SELECT iid, chrom, pos, ref, alt, gt FROM vcfgt"),
        "vcf_calls": sql(f"""SELECT iid, chr, start, "end", ref, alt, info, gt FROM (
  SELECT iid, {variant}, unnest(CASE WHEN alt='G,C' THEN [1,2] ELSE [1] END) AS allele, ac AS info, gt FROM vcfgt)
  WHERE list_contains(string_split(replace(split_part(gt,':',1),'|','/'),'/'), CAST(allele AS VARCHAR))"""),
        "chet_genes": sql("SELECT iid, gene, count(*) AS n FROM ranked WHERE zyg='het' GROUP BY iid, gene HAVING count(*)>=2"),
        "distinct_indels": sql(f"SELECT {V}, raw_score, phred FROM indel"),
        "stage_audit": sql(f"""SELECT a.iid, n_raw, n_clean, n_candidate, coalesce(n_ranked,0) AS n_ranked FROM
  (SELECT iid, count(*) AS n_raw, count(*) FILTER (why='') AS n_clean, count(*) FILTER (why='' AND geno IN ('het','hom','hem','het_female','hom_female')) AS n_candidate FROM reasoned GROUP BY iid) a
  LEFT JOIN (SELECT iid, count(*) AS n_ranked FROM (SELECT iid FROM single WHERE rk=1 UNION ALL SELECT iid FROM pairs WHERE rk<=2) GROUP BY iid) b ON a.iid=b.iid"""),
        "worst_per_gene": sql(f"SELECT {CALLED}, geno, {CLAMPED} FROM ranked WHERE rk=1"),
        "worst_pair": sql(f"SELECT {CALLED}, replace(geno,'het','chet') AS geno, {CLAMPED}, CAST(rk AS INT) AS rank FROM ranked WHERE zyg='het' AND cnt>=2 AND rk<=2"),
        "pair_prob": sql(f"SELECT {CALLED}, CAST(rk AS INT) AS rank, pair_p AS prob FROM pairs WHERE rk<=2"),
        "model_het": sql(f"SELECT {model}, prob FROM single WHERE zyg='het' AND rk=1"),
        "model_hom": sql(f"SELECT {model}, prob FROM single WHERE zyg='hom' AND rk=1"),
        "model_chet": sql(f"SELECT {model}, pair_p AS prob FROM pairs WHERE rk<=2"),
        "model_hem": sql(f"SELECT {model}, prob FROM single WHERE zyg='hem' AND rk=1"),
        "rank_variants": sql(WORST),
        "report_all": sql(f"SELECT {OUT}, prob FROM single UNION ALL SELECT {OUT}, chet_p AS prob FROM pairs"),
        "rank_variants_full": _full_ranked("cadd16"),
        "rank_variants_cadd13_v14": _full_ranked("cadd13_v14"),
        "rank_variants_cadd13_v13": _full_ranked("cadd13_v13"),
        "report_all_full": _full_ranked("cadd16", report_all=True),
        "dropped_variants": sql(f"SELECT {dropped} FROM reasoned WHERE (iid, key) NOT IN (SELECT iid, key FROM clean)"),
        "dropped_variants_full": sql(
            f"SELECT DISTINCT {full_dropped}, substr(why,2) AS drop_reason FROM fwhy WHERE (iid, key) NOT IN (SELECT iid, key FROM fclean)",
            _full("cadd13_v14"),
        ),
        "candidate_report": sql(
            """SELECT key, gene, dz_model, count(DISTINCT o.iid) AS n_cases FROM (SELECT iid, key, gene, dz_model, prob FROM fsingle WHERE rk=1
  UNION ALL SELECT iid, key, gene, dz_model, pair_p FROM fpairs WHERE rk<=2) o JOIN ped p ON p.iid=o.iid AND p.status=2
  WHERE prob<0.001 AND (key, gene) NOT IN (SELECT key, gene FROM allrows WHERE status=1 AND geno NOT IN ('ref','miss'))
  AND key NOT IN (SELECT """ + KEY + """ FROM call JOIN ped ON call.iid=ped.iid WHERE status=1 AND sex=0 AND regexp_matches(split_part(gt,':',1),'[1-9]'))
  GROUP BY key, gene, dz_model HAVING count(DISTINCT o.iid)>=2""",
            _full("cadd16"),
        ),
        "outputs_of_one_pass": sql(
            f"""SELECT iid, count(*) FILTER (kind=1) AS n_ranked, count(*) FILTER (kind=2) AS n_dropped FROM (
  SELECT iid, 1 AS kind FROM fsingle WHERE rk=1 UNION ALL SELECT iid, 1 FROM fpairs WHERE rk<=2 UNION ALL
  SELECT iid, 2 FROM (SELECT DISTINCT {full_dropped} FROM fwhy WHERE (iid, key) NOT IN (SELECT iid, key FROM fclean))) GROUP BY iid""",
            _full("cadd13_v14"),
        ),
        "incremental_report": _full_ranked("cadd16"),
        "rank_from_vcf": sql(from_vcf_body, from_vcf),
        "join_stored_calls": sql(f"SELECT {CALLED}, gt, filter, phred FROM raw"),
        "repeated_nulls": sql("SELECT 'het' AS model, eth, gene, 2 AS count FROM nullgene CROSS JOIN (SELECT DISTINCT eth FROM weight)"),
        "rejects": sql("""SELECT iid, 'sex' AS reason FROM ped WHERE sex=0 UNION ALL SELECT DISTINCT iid, 'missing' FROM call WHERE iid NOT IN (SELECT iid FROM ped)
  UNION ALL SELECT iid, 'not_in_vcf' FROM ped WHERE sex<>0 AND iid NOT IN (SELECT 'S'||o_custkey FROM orders WHERE o_orderpriority='1-URGENT')"""),
        "cnv_union": sql(f"SELECT iid, {V}, gene, exonic_func, filter, geno0 AS geno FROM cnv0"),
        "merge_cnv": sql(f"SELECT {CALLED}, exonic_func, geno, false AS is_cnv FROM raw UNION ALL SELECT {CALLED}, exonic_func, geno, true FROM cnv"),
        "ranked_report_rows": sql(f"""SELECT iid AS "ID", key AS "Key", chr AS "Chr", start AS "Start", ref AS "Ref", alt AS "Alt", total_read AS "Total_Read", alt_read AS "Alt_Read",
  gene AS "Gene_wgEncodeGencodeBasicV35", func AS "Func_wgEncodeGencodeBasicV35", exonic_func AS "ExonicFunc_wgEncodeGencodeBasicV35", aa_change AS "AAChange_wgEncodeGencodeBasicV35",
  gene_detail AS "GeneDetail_wgEncodeGencodeBasicV35", af AS "AF", af_afr AS "AF_afr", af_nfe AS "AF_nfe", phred AS "CADD16phred", clnsig AS "CLNSIG", clndn AS "CLNDN",
  geno AS "Geno", dz_model AS "Dz_Model", prob AS "PSAP" FROM ({WORST})"""),
    }
