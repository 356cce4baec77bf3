"""Derived views on the driver tables, in SQL that Spark and DuckDB both run.

``{name}`` marks a base table; ``Tables`` fills in DataFrames for Spark, and
``ctes`` fills in the plain names for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genespark.session import materialize

BASE = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    "fx_samples": """
        select concat('N', n_nationkey) as short,
               case when n_regionkey <= 2 then 'IN' else 'OUT' end as grp,
               n_name as species, concat('R', n_regionkey) as taxon_group
        from {nation}""",
    "fx_hits": """
        select concat('P', l_partkey) as query_id, concat('N', l_partkey % 25) as query_proteome,
               concat('T', l_suppkey, '_', l_orderkey % 4) as target_id,
               concat('N', s_nationkey) as target_proteome,
               cast(concat('1e-', (l_orderkey*31 + l_linenumber*7 + l_partkey) % 60) as double) as evalue,
               l_quantity as bitscore,
               cast((l_orderkey*13 + l_linenumber*29) % 101 as int) as qcov
        from {lineitem} join {supplier} on l_suppkey = s_suppkey
        where s_nationkey <> l_partkey % 25""",
    "fx_paralogs": """
        select concat('P', p_partkey) as protein_id, concat('P', p_partkey + 25) as paralog_id
        from {part} where p_partkey % 3 <> 0 and p_partkey + 25 <= (select max(p_partkey) from {part})""",
    "fx_strains": """
        select concat('S', s_suppkey) as short,
               case when s_suppkey % 5 = 0 then 'OUT' else 'IN' end as grp,
               concat('C', s_nationkey % 4) as clade,
               case when s_suppkey % 7 = 3 then 0 else 1 end as is_rep
        from {supplier}""",
    "fx_genes": """
        select concat('S', l_suppkey) as short, concat('G', l_orderkey, '_', l_linenumber) as protein_id,
               concat('F', l_partkey % 200) as family, concat('ctg', l_orderkey % 3) as contig,
               (l_orderkey*7919 + l_linenumber*104729) % 1500000 as g_start,
               cast(300 + 10*l_quantity as bigint) as g_len
        from {lineitem}""",
    "fx_presence": """
        select concat('F', l_partkey % 200) as family, concat('S', l_suppkey) as short, count(*) as copies
        from {lineitem}
        where (l_partkey % 200) % 10 < 2 or (l_partkey + l_suppkey * 3) % 10 < (l_partkey % 200) % 7
        group by 1, 2""",
    "fx_elements": """
        select concat('E', s_suppkey) as element_id, concat('S', s_suppkey) as short,
               concat('ctg', s_suppkey % 3) as contig,
               (s_suppkey*99991) % 1400000 as e_start, (s_suppkey*99991) % 1400000 + 60000 as e_end
        from {supplier} where s_suppkey % 5 <> 0""",
    "fx_domains": """
        select concat('F', p_partkey % 200) as family, concat('D', p_size) as domain
        from {part} group by 1, 2""",
    # domain hits with spans: family profile against target proteins of a proteome
    "fx_domain_hits": """
        select concat('T', l_suppkey, '_', l_orderkey % 40) as target, concat('F', l_partkey % 200) as query,
               concat('N', s_nationkey) as proteome, cast(200 + l_partkey % 200 * 2 as bigint) as qlen,
               cast(concat('1e-', (l_orderkey*31 + l_partkey) % 12) as double) as full_evalue,
               cast(concat('1e-', (l_orderkey*17 + l_linenumber) % 10) as double) as i_evalue,
               cast(1 + (l_orderkey*13) % 150 as bigint) as hmm_from,
               cast(1 + (l_orderkey*13) % 150 + 20 + (l_linenumber*37) % 90 as bigint) as hmm_to
        from {lineitem} join {supplier} on l_suppkey = s_suppkey""",
    # genome (translated) hits of absent-gene queries
    "fx_genome_hits": """
        select concat('F', l_partkey % 200) as family, concat('S', l_suppkey) as short,
               concat('ctg', l_orderkey % 3) as contig,
               80 + (l_orderkey*7 + l_linenumber) % 21 as pident, 60 + (l_orderkey*11 + l_linenumber*3) % 41 as qcovs,
               l_quantity as bitscore, (l_orderkey*7919 + l_linenumber*104729 + 250) % 1500000 as sstart,
               (l_orderkey*7919 + l_linenumber*104729 + 250) % 1500000 + 600 as send,
               concat('H', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey) as hit_id,
               cast(concat('1e-', (l_orderkey*3 + l_linenumber) % 30) as double) as evalue,
               cast(1 + (l_orderkey*5) % 200 as bigint) as qstart,
               cast(1 + (l_orderkey*5) % 200 + 30 + (l_linenumber*41) % 120 as bigint) as qend
        from {lineitem}""",
    "fx_dist": """
        select concat('S', s_suppkey) as a, concat('S', s_suppkey + 1) as b,
               cast((s_suppkey * 37) % 100 as double) as dist from {supplier}
        union all
        select concat('S', s_suppkey), concat('S', s_suppkey + 10), cast((s_suppkey * 53) % 100 as double) from {supplier}""",
    # hits between proteins of one family, with some registered paralogs among them
    "fx_family_hits": """
        select concat('P', p_partkey) as query_id, concat('P', p_partkey + 200) as target_id,
               cast(concat('1e-', (p_partkey * 7) % 12) as double) as evalue from {part}
        union all
        select concat('P', p_partkey), concat('P', p_partkey + 400),
               cast(concat('1e-', (p_partkey * 5) % 9) as double) from {part}""",
    "fx_family_paralogs": """
        select concat('P', p_partkey) as protein_id, concat('P', p_partkey + 200) as paralog_id
        from {part} where p_partkey % 4 = 0""",
    # gene-cluster regions; every seventh on a strain that was not annotated
    "fx_regions": """
        select concat('Q', s_suppkey) as cluster_id, concat('S', s_suppkey) as short,
               concat('ctg', s_suppkey % 3) as contig, concat('T', s_suppkey % 4) as type,
               (s_suppkey*99991 + 30000) % 1400000 as start, (s_suppkey*99991 + 30000) % 1400000 + 40000 as stop,
               case when s_suppkey % 7 = 0 then 0 else 1 end as testable
        from {supplier}""",
    # protein -> family, some proteins in none
    "fx_members": """
        select concat('P', p_partkey) as member, concat('F', p_partkey % 200) as family
        from {part} where p_partkey % 7 <> 0""",
    # clusters of one to about ten proteins
    "fx_clusters": """
        select concat('P', p_partkey) as member,
               concat('K', case when p_partkey % 11 = 0 then p_partkey else p_partkey % 150 + p_size % 3 end) as family
        from {part}""",
    "fx_sources": """
        select concat('P', p_partkey) as member, concat('N', p_partkey % 25) as source_proteome
        from {part} where p_partkey % 17 <> 0""",
    "fx_roles": """
        select concat('N', n_nationkey) as short,
               case n_regionkey when 0 then 'DISCOVERY_TARGET' when 1 then 'NEAR_INGROUP' when 2 then 'DISCOVERY_OUT'
                    else 'BROAD_OUTGROUP' end as grp
        from {nation}""",
    "fx_busco": """
        select concat('B', p_partkey % 60) as busco_id, concat('N', p_partkey % 25) as species,
               concat('P', min(p_partkey)) as protein_id
        from {part} where p_partkey % 10 < 4 group by 1, 2""",
    "fx_busco_lengths": """
        select concat('B', p_partkey % 60) as busco_id, cast(max(p_size) * 17 as bigint) as length
        from {part} where p_partkey % 10 < 4 and p_partkey % 60 <> 3 group by 1""",
    "fx_controls": """
        select concat('CT', p_partkey) as control_id,
               case when p_partkey % 2 = 0 then 'positive' else 'negative' end as class,
               case p_partkey % 3 when 0 then 'protein_id' when 1 then 'busco' else 'fasta' end as anchor_type,
               case p_partkey % 3 when 0 then concat('P', p_partkey) when 1 then concat('B', p_partkey % 70)
                    else concat('T', p_partkey % 120, '_', p_partkey % 40) end as anchor
        from {part} where p_size % 5 = 0""",
    "fx_sweep": """
        select 0.1 * (p_size % 4 + 1) as min_seq_id, 0.8 as cov, 1e-3 as hmm_evalue, 0.3 as hmm_cov,
               cast(p_size as double) as hmm_residues, count(*) as n_families,
               case when p_size % 9 = 0 then null else count(*) + p_size end as n_novelties,
               (p_size % 10 + 5) / 15.0 as busco_recovery,
               cast(null as double) as presence_recovery,
               case when p_size % 8 = 1 then null else (p_size % 6 + 2) / 8.0 end as recall,
               (p_size % 5) / 20.0 as fp_rate, case when p_size % 13 = 0 then 0 else 1 end as run_ok
        from {part} group by p_size""",
}


class Tables:
    """Base tables and derived views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def once(self, name: str, make) -> DataFrame:
        """Written intermediate that several steps of one query share."""
        if name not in self._made:
            self._made[name] = materialize(make())
        return self._made[name]

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = {t: self.base(t) for t in BASE if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.view(f"fx_{name}") if f"fx_{name}" in VIEWS else self.base(name)


def ctes(*names: str, **extra: str) -> str:
    """WITH clause that defines the named views (and ``extra`` queries after them)."""
    parts = [f"{n} as ({VIEWS[n].format(**{t: t for t in BASE})})" for n in names]
    parts += [f"{n} as ({q})" for n, q in extra.items()]
    return "with " + ",\n".join(parts) + "\n"
