"""Default parameter values. Operators take them as arguments; nothing reads them implicitly."""

# ---------------------------------------------------------------------------
# They have to be equal to the published formats and rules.
# ---------------------------------------------------------------------------

# Values that count as "nothing was provided" although the field is filled.
EMPTY_VALUES = [
    "not applicable",
    "not collected",
    "not provided",
    "restricted access",
    "undef",
    "",
]

# Sample sections in report order, and the rule statuses of the coverage report.
SECTIONS = [
    "standard",
    "organism",
    "specimen from organism",
    "pool of specimens",
    "cell specimen",
    "cell culture",
    "cell line",
]
COVERAGE_STATUSES = ["recommended", "optional"]
MANDATORY_STATUS = "mandatory"

# Rule names whose document field is spelled differently, and nested-document
# fields that stay at the top level.
FIELD_ALIASES = {"sampleDescription": "description"}
SHARED_FIELDS = ["derivedFrom"]

# Registration manifest.
MANIFEST_COLUMNS = [
    "accession",
    "epigenome",
    "assay",
    "br",
    "tr",
    "is_control",
    "md5sum",
    "local_url",
    "analysis",
    "Project/lab",
    "ontologies",
    "control_id",
    "species",
    "xrefs",
]
ONTOLOGY_CLASSES = {
    "SAMPLE": ["Sex", "breed", "material"],
    "TISSUE": ["organism part", "cell type"],
    "CONDITION": ["health status at collection", "developmental stage"],
}
ENTITY_OUTPUT_ATTRIBUTES = [
    "Sample Name",
    "Organism",
    "Sex",
    "material",
    "breed",
    "organism part",
    "cell type",
    "health status at collection",
    "developmental stage",
]
NAME_ATTRIBUTE = "Sample Name"
SPECIES_ATTRIBUTE = "Organism"
CONTROL_ASSAY = "input DNA"
CONTROL_LABEL = "WCE"
TARGET_ATTRIBUTE = "experiment target"
LOOKUP_STRATEGY = "ChIP-seq"
STATUS_ATTRIBUTE = "Metadata validation status"
STATUS_ERROR = "error"

# Complaints about dates, with the date between the two groups.
DATED_MESSAGE = r"(?d)^(.+Date)\s\d+\/\d+\/\d+\s(.+)$"

# ---------------------------------------------------------------------------
# Callers' arguments: defaults for one kind of collection, not fixed.
# ---------------------------------------------------------------------------

# Selection of public sequencing runs.
COLLECTION_COLUMNS = {"type": "FASTQ", "table_name": "file"}
RUN_COLUMNS = {"status": ["public"]}
EXPERIMENT_COLUMNS = {
    "status": ["public"],
    "library_strategy": ["ChIP-Seq"],
    "instrument_platform": ["ILLUMINA"],
}
SAMPLE_COLUMNS = {"status": ["public"]}
STUDY_COLUMNS = {"status": ["public"]}

# Validation logs: messages to ignore, and messages that ask for a curator.
NOISE_MESSAGES = ["id_number:attribute not in rule set"]
CANDIDATE_PATTERNS = [
    "gestational age at sample collection:no text provided",
    "This field is optional, so if not providing",
]

# ---------------------------------------------------------------------------
# Fixed values again: forms and paths of the documents.
# ---------------------------------------------------------------------------

# URL audit: the accepted form, and the URI-typed fields of each document type.
URL_PATTERN = (
    r"^((http|ftp)s?:\/\/)?(www\.)?[-a-zA-Z0-9@:%._\+~#=]{2,256}\.[a-z]{2,6}\b"
    r"([-a-zA-Z0-9@:%_\+.~#?&\/=]*)$"
)
URL_FIELDS = {
    "organism": ["pedigree"],
    "specimen": [
        "availability",
        "specimenFromOrganism.specimenCollectionProtocol.url",
        "specimenFromOrganism.specimenPictureUrl",
        "poolOfSpecimens.poolCreationProtocol.url",
        "poolOfSpecimens.specimenPictureUrl",
        "cellSpecimen.purificationProtocol.url",
        "cellCulture.cellCultureProtocol.url",
        "cellLine.cultureProtocol.url",
    ],
    "experiment": [
        "experimentalProtocol.url",
        "extractionProtocol.url",
        "ATAC-seq.transposaseProtocol.url",
        "BS-seq.bisulfiteConversionProtocol.url",
        "BS-seq.pcrProductIsolationProtocol.url",
        "ChiP-seq histone.chipProtocol.url",
        "DNase-seq.dnaseProtocol.url",
        "Hi-C.hi-cProtocol.url",
        "RNA-seq.rnaPreparation3AdapterLigationProtocol.url",
        "RNA-seq.rnaPreparation5AdapterLigationProtocol.url",
        "RNA-seq.libraryGenerationPcrProductIsolationProtocol.url",
        "RNA-seq.preparationReverseTranscriptionProtocol.url",
        "RNA-seq.libraryGenerationProtocol.url",
        "WGS.libraryGenerationPcrProductIsolationProtocol.url",
        "WGS.libraryGenerationProtocol.url",
    ],
}

# Relationship types, group accession form.
PARENT_RELATION = "derived from"
MEMBER_RELATION = "has member"
GROUP_PATTERN = r"^SAMEG\d+"

# Size units, 1024-based.
SIZE_UNITS = ["B", "kB", "MB", "GB", "TB", "PB"]

# Expected sample fields, in index order.
SAMPLE_FIELDS = [
    "Centre",
    "Sample Name",
    "Sample Description",
    "Material",
    "Organism",
    "Sex",
    "animal age at collection",
    "availability",
    "birth date",
    "birth location",
    "birth location latitude",
    "birth location longitude",
    "birth weight",
    "breed",
    "cell culture protocol",
    "cell type",
    "child of",
    "culture conditions",
    "culture type",
    "delivery ease",
    "derived from",
    "developmental stage",
    "environmental conditions",
    "fasted status",
    "gestational age at sample collection",
    "health status",
    "health status at collection",
    "lactation duration",
    "markers",
    "number of passages",
    "number of pieces",
    "organism part",
    "parturition trait",
    "pedigree",
    "physiological conditions",
    "placental weight",
    "pregnancy length",
    "project",
    "purification protocol",
    "specimen collection date",
    "specimen collection protocol",
    "specimen picture url",
    "specimen size",
    "specimen volume",
    "specimen weight",
    "strain",
    "Derived from",
]

# Vocabulary: types defined in the shared schema file, referred to by prefix.
COMMON_PREFIX = "com:"
