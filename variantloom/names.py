"""Column names and lookup values shared by the whole library.

Everything below is a fixed value: results are only right with exactly these.
"""

KEY = ["CHROM", "POS", "REF", "ALT"]

# The same with the number first: Spark sorts compare it before any text.
SORT_KEY = ["POS", "CHROM", "REF", "ALT"]

MISSING = "."

# Effect terms from the most to the least severe (rank = position).
EFFECT_ORDER = [
    "exon_loss_variant",
    "frameshift_variant",
    "stop_gained",
    "stop_lost",
    "start_lost",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "disruptive_inframe_deletion",
    "conservative_inframe_deletion",
    "inframe_insertion",
    "disruptive_inframe_insertion",
    "conservative_inframe_insertion",
    "inframe_deletion",
    "missense_variant",
    "splice_region_variant",
    "stop_retained_variant",
    "initiator_codon_variant",
    "synonymous_variant",
    "start_retained",
    "coding_sequence_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "5_prime_UTR_premature_start_codon_gain_variant",
    "intron_variant",
    "non_coding_exon_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "TF_binding_site_variant",
    "regulatory_region_variant",
    "intergenic_region",
    "transcript",
]

# Clinical significance codes, in the order they are replaced.
CLINVAR_LABELS = {
    "255": "other",
    "0": "Uncertain significance",
    "1": "not provided",
    "2": "Benign",
    "3": "Likely Benign",
    "4": "Likely pathogenic",
    "5": "Pathogenic",
    "6": "drug response",
    "7": "histocompatibility",
}

# Fields of one ANN entry when no header names them.
ANN_FIELDS = [
    "Allele",
    "Annotation",
    "Annotation_Impact",
    "Gene_Name",
    "Gene_ID",
    "Feature_Type",
    "Feature_ID",
    "Transcript_BioType",
    "Rank",
    "HGVS.c",
    "HGVS.p",
    "cDNA.pos / cDNA.length",
    "CDS.pos / CDS.length",
    "AA.pos / AA.length",
    "Distance",
    "ERRORS / WARNINGS / INFO",
]

# Columns holding one value per alternate allele.
PER_ALLELE_COLUMNS = [
    "ID", "AC", "AF", "SAMPLES_AF", "MLEAC", "MLEAF", "VARTYPE", "dbSNPBuildID",
]
PER_ALLELE_PREFIXES = ("1000", "CLINVAR")

# Quality columns of a single sample, left out of comparisons.
SINGLE_SAMPLE_COLUMNS = [
    "QUAL", "FILTER", "DP", "FS", "MQ", "SOR", "QD", "SET", "BASEQRANKSUM",
    "CLIPPINGRANKSUM", "MQRANKSUM", "READPOSRANKSUM", "AC", "SAMPLES_AF",
    "MLEAC", "MLEAF", "DBSNPBUILDID",
]

# A column whose name contains one of these describes the variant,
# not the sample, so comparisons keep a single copy of it.
VARIANT_LEVEL_MARKS = ["1000GP3", "CLINVAR", "ESP6500", "RSID", "POLYPHEN"]

# Column order of a report.
REPORT_COLUMNS = [
    "GENE_NAME", "AMINOCHANGE", "HGVS.P", "HGVS.C", "RSID", "IMPACT", "EFFECT",
    "FEATURE_ID", "VARDB_FREQ", "ALLELE_FREQ", "1000GP3_AF", "1000GP3_AFR_AF",
    "1000GP3_AMR_AF", "1000GP3_EAS_AF", "1000GP3_EUR_AF", "1000GP3_SAS_AF",
    "ESP6500_MAF_EA", "ESP6500_MAF_AA", "ESP6500_MAF_ALL", "CLINVAR_CLNSIG",
    "CLINVAR_CLNDSDB", "CLINVAR_CLNDSDBID", "CLINVAR_CLNDBN",
    "CLINVAR_CLNREVSTAT", "CLINVAR_CLNACC", "POLYPHEN_PRED", "POLYPHEN_SCORE",
    "VENN", "ZIGOSITY", "CHROM", "POS", "REF", "ALT", "VARTYPE",
]

# Leading columns of a report annotated from the cohort.
ANNOTATED_LEADING_COLUMNS = [
    "GENE_NAME", "AMINOCHANGE", "HGVS.P", "HGVS.C", "RSID", "IMPACT", "EFFECT",
    "VARDB_FREQ", "ALLELE_FREQ",
]

# Column order of the sequencing vendor's sheet.
VENDOR_COLUMNS = [
    "CHROM", "POS", "REF", "ALT", "DP", "AD", "QUAL", "MQ", "Zygosity",
    "FILTER", "Effect", "IMPACT", "Gene_Name", "Feature_Type", "Feature_ID",
    "Transcript_BioType", "Rank/Total", "HGVS.c", "HGVS.p", "REF_AA", "ALT_AA",
    "cDNA_pos/cDNA_length", "CDS_pos/CDS_length", "AA_pos/AA_length",
    "Distance", "dbSNP142_ID", "1000Gp3_AF", "1000Gp3_AFR_AF",
    "1000Gp3_AMR_AF", "1000Gp3_EAS_AF", "1000Gp3_EUR_AF", "1000Gp3_SAS_AF",
    "ESP6500_MAF_EA", "ESP6500_MAF_AA", "ESP6500_MAF_ALL", "SIFT_score",
    "SIFT_pred", "Polyphen2_HDIV_score", "Polyphen2_HDIV_pred",
    "Polyphen2_HVAR_score", "Polyphen2_HVAR_pred", "CLINVAR_CLNSIG",
    "CLINVAR_CLNDSDB", "CLINVAR_CLNDSDBID", "CLINVAR_CLNDBN",
    "CLINVAR_CLNREVSTAT", "CLINVAR_CLNACC",
]

# Link targets.
RSID_URL = "https://varsome.com/variant/hg19/"
GENE_URL = "https://www.ncbi.nlm.nih.gov/omim/?term="

# Place of the sex chromosomes in the vendor's sort order.
CHROMOSOME_RANKS = {"X": 30, "Y": 40}
