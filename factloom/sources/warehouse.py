"""Reference tables joined to facts: residues seen, gene records, corpus index, rows with their paper, paper surfaces, titles of variation records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import counts


def ordered_distinct(values: str, order: str) -> Column:
    """An aggregate: the values in order of their first appearance, each once, blanks left out."""
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.trim(values) != "", F.struct(F.col(order).alias("o"), F.trim(values).alias("v"))))), lambda x: x["v"])
    return F.array_distinct(listed)


def residues(warehouse: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted (gene, position, protein, coding) with rows in the warehouse: residues and transcripts met, in order, and whether a row's notation ends like the one wanted.

    The warehouse has row, gene, position, transcript, hgvs_p, hgvs_c, ref, alt. It is
    reduced to the wanted positions first, by a semi join, so a large gene costs
    no more than its rows at those positions.
    """
    tidy = lambda c: F.lower(F.regexp_replace(F.trim(c), r"\s+", ""))
    asked = wanted.withColumn("gene", F.upper(F.trim("gene")))
    near = warehouse.withColumn("gene", F.upper(F.trim("gene"))).join(asked.select("gene", "position").distinct(), ["gene", "position"], "left_semi")
    lists = near.groupBy("gene", "position").agg(
        *[ordered_distinct(c, "row").alias(n) for c, n in (("ref", "references"), ("alt", "alternates"), ("transcript", "transcripts"))],
        F.collect_set(tidy("hgvs_p")).alias("_p"), F.collect_set(tidy("hgvs_c")).alias("_c"),
    )
    ends = lambda names, said: F.coalesce((tidy(said) != "") & F.exists(names, lambda x: x.endswith(tidy(said))), F.lit(False))
    out = asked.join(lists, ["gene", "position"])
    upper = lambda c: F.transform(c, lambda x: F.upper(x))
    return out.select(*asked.columns, F.array_distinct(upper("references")).alias("references"), F.array_distinct(upper("alternates")).alias("alternates"), "transcripts", ends("_p", "protein").alias("matched_p"), ends("_c", "coding").alias("matched_c"))


def merged_genes(built_in: DataFrame, found: DataFrame) -> DataFrame:
    """Gene records of two sources (gene, aliases, sources, length): lists joined in order, each entry once; a built-in length stands, as a found one may be of a slice."""
    b, f = built_in.select("gene", *[F.col(c).alias(f"_b_{c}") for c in ("aliases", "sources", "length")]), found.select("gene", *[F.col(c).alias(f"_f_{c}") for c in ("aliases", "sources", "length")])
    empty = F.array().cast("array<string>")
    both = lambda c: F.array_distinct(F.concat(F.coalesce(f"_b_{c}", empty), F.coalesce(f"_f_{c}", empty)))
    length = F.coalesce("_b_length", "_f_length")
    return b.join(f, "gene", "full_outer").select("gene", both("aliases").alias("aliases"), both("sources").alias("sources"), length.alias("length"))


def corpus_index(index: DataFrame, order: str) -> DataFrame:
    """The last row of each (gene, pmid) of an index; genes in upper case, ids as whole digits."""
    rows = index.withColumn("gene", F.upper(F.trim("gene"))).withColumn("pmid", counts.normal_id(F.col("pmid")))
    packed = F.max_by(F.struct(*[F.col(c) for c in rows.columns if c not in ("gene", "pmid")]), order).alias("_r")
    return rows.groupBy("gene", "pmid").agg(packed).select("gene", "pmid", "_r.*")


def pipeline_rows(facts: DataFrame, variants: DataFrame, links: DataFrame, papers: DataFrame, pmid: str | None = None) -> DataFrame:
    """Facts with their variant, their link's place and notes, and their paper's title; of one paper if it is given, which reaches the scans."""
    rows = facts if pmid is None else facts.where(F.col("pmid") == pmid)
    out = rows.join(variants, "variant_id").join(links.select("variant_id", "pmid", "source_location", "additional_notes"), ["variant_id", "pmid"], "left").join(papers.select("pmid", "title"), "pmid", "left")
    return out


def paper_surfaces(papers: DataFrame, variants: DataFrame, people: DataFrame, facts: DataFrame, tables: DataFrame) -> DataFrame:
    """Per paper what is known of it: variants, persons, tables, facts, and carriers by sum. Each side is counted before it is joined."""
    n = lambda rows, name: rows.groupBy("pmid").agg(F.count(F.lit(1)).alias(name))
    sums = facts.groupBy("pmid").agg(F.count(F.lit(1)).alias("n_facts"), F.sum("carriers").cast("long").alias("carriers"))
    out = papers.select("pmid").join(n(variants, "n_variants"), "pmid", "left").join(n(people, "n_people"), "pmid", "left").join(n(tables, "n_tables"), "pmid", "left").join(sums, "pmid", "left")
    return out.fillna(0, ["n_variants", "n_people", "n_tables", "n_facts"])


def named_changes(titles: DataFrame, title: str) -> DataFrame:
    """Coding and protein change of a record's title, NM_000238.4(KCNH2):c.1682C>T (p.Ala561Val); rows without either are left out."""
    part = lambda p: F.nullif(F.regexp_extract(title, p, 1), F.lit(""))
    return titles.withColumn("coding", part(r"(c\.[^\s()]+)")).withColumn("protein", part(r"\((p\.[^()]+)\)")).where("coding is not null or protein is not null")
