"""Declared schemas and fixed values of the data model."""

from pyspark.sql import types as T

DIMS = ("n1", "n2", "n3", "n4", "n5")
DIMS_EN = tuple(f"{d}_en" for d in DIMS)

FACT = T.StructType(
    [
        T.StructField("variable_id", T.IntegerType()),
        T.StructField("unitId", T.StringType()),
        T.StructField("unitName", T.StringType()),
        T.StructField("unitLevel", T.ByteType()),
        T.StructField("year", T.ShortType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("attr_id", T.ByteType()),
    ]
)
OBSERVATION = ["variable_id", "unitId", "unitName", "unitLevel", "year", "value"]

VARIABLES = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("subjectId", T.StringType())]
    + [T.StructField(d, T.StringType()) for d in DIMS]
    + [
        T.StructField("level", T.ByteType()),
        T.StructField("measureUnitId", T.IntegerType()),
        T.StructField("measureUnitName", T.StringType()),
    ]
)
SUBJECTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("id", "parentId", "name", "description")]
)
SUBJECTS_EN = T.StructType(
    [T.StructField("subjectId", T.StringType()), T.StructField("name_en", T.StringType())]
)
LABELS_RAW = T.StructType(
    [T.StructField("id", T.IntegerType()), T.StructField("subjectId", T.StringType())]
    + [T.StructField(d, T.StringType()) for d in DIMS]
    + [T.StructField("measureUnitName", T.StringType())]
)
PAGE = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("totalRecords", T.LongType()),
        T.StructField("results", T.ArrayType(LABELS_RAW)),
    ]
)
SUBJECT_RESPONSE = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]
)
MANIFEST = T.StructType(
    [
        T.StructField("tbl", T.StringType()),
        T.StructField("unitLevel", T.ByteType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("var_min", T.IntegerType()),
        T.StructField("var_max", T.IntegerType()),
        T.StructField("rows", T.LongType()),
    ]
)

# Fixed values of the data model: the aggregate member of a dimension, the spelling of a
# missing dimension, level codes and names, table names, accepted level aliases, raw file names.
TOTAL = "ogółem"
MISSING = "NA"
LEVELS = (6, 5, 4, 2, 1)
LEVEL_NAMES = {6: "gmina", 5: "powiat", 4: "podregion", 2: "wojewodztwo", 1: "makroregion"}
DOC_LEVEL_NAMES = {**LEVEL_NAMES, 3: "region", 0: "Polska"}
SHORT_LEVEL_NAMES = {6: "gmina", 5: "powiat", 4: "podregion", 2: "woj.", 1: "makro"}
FACT_TABLES = {
    6: "facts_gminy",
    5: "facts_powiaty",
    4: "facts_podregiony",
    2: "facts_wojewodztwa",
    1: "facts_makroregiony",
}
LEVEL_ALIASES = {
    6: ("gmina", "gminy"),
    5: ("powiat", "powiaty"),
    4: ("subregion", "podregion", "subregiony", "podregiony"),
    2: ("voivod", "voivodeship", "woj", "wojewodztwo", "wojewodztwa"),
    1: ("macroregion", "makroregion", "makroregiony"),
}
RAW_FILE_LEVELS = {"country": 1, "macroregion": 2, "voivod": 4, "powiaty": 5, "gminy": 6}

# Fixed limits of the explorer and of the file layout.
MAX_VARIABLES = 60
PREVIEW_ROWS = 3000
TABLE_ROWS = 1000
MAX_SERIES = 8
MAX_SUBJECTS = 40
MAX_UNITS = 100
MIN_QUERY = 2
BYTES_PER_ROW = 95
WARN_ROWS = 500_000
HEAVY_ROWS = 3_000_000
PAGE_SIZE = 100
ROW_GROUP_ROWS = 1_000_000
LEVEL_PARTS = {6: 16, 5: 4, 4: 1, 2: 1, 1: 1}

# One CSV dialect for reading and writing: quotes are doubled, blanks at the edges belong to the text.
CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
