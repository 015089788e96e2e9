"""Schemas of the relations. Coordinates are 1-based and half-open; sinks convert them."""

from pyspark.sql.types import StructType

_DDL = {
    "manifest": "url1 string, md5_1 string, url2 string, md5_2 string, sample_label string",
    "samples": "sample_index int, sample_label string",
    "contigs": "rname string, length long, rank_by_len int, rank_by_name int",
    "reads": "canon_seq string, is_reversed boolean, qname string, qual string, sample int, mate_seq string",
    "readlets": "readlet_seq string, read_id long, is_reversed boolean, disp5 int, disp3 int",
    "readlet_hits": "read_id long, disp5 int, disp3 int, rname string, reverse boolean, pos long",
    "junction_obs": "rname_strand string, start long, end_pos long, sample int, count long",
    "junctions_filtered": "rname_strand string, sample int, start long, end_pos long",
    "junctions_collected": "rname_strand string, start long, end_pos long, samples array<int>, counts array<long>",
    "junction_configs": "rname_strand string, starts array<long>, ends array<long>, left_ext long, right_ext long, left_avail long, right_avail long",
    "fragments": "rname string, strand string, start long, exon_sizes array<long>, intron_sizes array<long>, left_avail long, right_avail long, sequence string",
    "alignments": "sample int, qname string, flag int, rname string, pos long, mapq int, cigar string, rnext string, pnext long, tlen long, seq string, qual string, as_score int, xs_score int, nm int, md string, tags map<string,string>",
    "exon_diff": "rname string, sample int, pos long, uniq boolean, diff long",
    "indel_junction": "type string, rname string, start long, end_pos long, strand_or_seq string, sample int, left_disp int, right_disp int, count long",
    "coverage": "rname string, sample int, pos long, cov long, ucov long",
    "norm_factors": "sample int, factor long, unique_factor long, auc long, unique_auc long",
}
SCHEMAS: dict[str, StructType] = {name: StructType.fromDDL(ddl) for name, ddl in _DDL.items()}
