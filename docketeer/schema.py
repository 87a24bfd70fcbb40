"""Input schemas and the fixed Hebrew keys; English column names everywhere else."""

from __future__ import annotations

from pyspark.sql import types as T

# The keys of the verdict files, by our column names.
ROLE_KEYS = {
    "judges": "לפני",
    "petitioner": "העותר",
    "defense": "המשיב",
    "petitioner_attorneys": "בשם העותר",
    "defense_attorneys": "בשם המשיב",
}
SUMMARY_KEY = "סיכום"
DATE_KEY = "תאריך"
PAGES_KEY = "עמודים"
DOC_TYPE_KEY = "סוג מסמך"
CASE_NO_KEY = "מספר הליך"
EXTRA_KEY = "מידע נוסף"
# Fixed value: what turns a role key into the key of its normalized list.
NORMALIZED_SUFFIX = " מנורמל"

ROLES = list(ROLE_KEYS)
LEGAL_ROLES = ["judges", "petitioner_attorneys", "defense_attorneys"]
PARTY_ROLES = ["petitioner", "defense"]

# The n-gram size chosen for each category.
CATEGORY_NGRAMS = {
    "Administrative": 9,
    "Civil": 9,
    "Constitutional": 4,
    "Criminal": 6,
    "Family": 8,
    "International law": 9,
    "Labor and Employment": 7,
    "National security, military, and the territories": 2,
    "Religious": 8,
    "Social security, Health Insurance, Pension": 7,
}
# The label below the floor, and the floor.
INCONCLUSIVE = "Inconclusive"
FLOOR = 0.5
# The category columns of the indicator table, in their order there.
INDICATOR_CATEGORIES = [
    "Family",
    "Labor and Employment",
    "Constitutional",
    "Administrative",
    "Civil",
    "Criminal",
    "International law",
    "National security, military, and the territories",
    "Religious",
    "Social security, Health Insurance, Pension",
    "Inconclusive",
]

# Titles removed from the names of judges and attorneys.
TITLES = [
    "לכבוד", "כבוד", "כב'", "הרשמת", "הרשם", "השופטת", "השופט", "שופטת", "שופט",
    "המשנה", "הנשיא", "השפוטת", "השפט", "המישנה", "הדופטת", "הש/ופט", "בדימ'", "בדימוס",
    "המשנָה", "המשנה-לנשיא", "המשנה-לנשיאה", "לנשיא", "(בדי'מ')", "(בדימ')", "(בדימ.)",
    "(בדימוס)", "כב", "(בדימ)", "בדימ", 'עו"ד', "עוד", "עו'ד", "עורך דין", "מר", "גברת",
    "אדון", "כבודה", 'עוה"ד', "עוהד", 'ד"ר', 'ועו"ד', 'ועוה"ד', 'וד"ר', "(סנגוריה ציבורית)",
    'עוד"', "יור", 'יו"ר', "יושב ראש", "פרופ'", "פרופסור", "דר'", "דוקטור", 'וע"ד', 'ןעו"ד',
    'ןע"ד', 'עו"ד', "עו'ד", "פרקליט", 'עו""ד', "נשיאת בית המשפט העליון", "גב'", "גברת",
    "הגב'", "הגב",
]

_names = T.ArrayType(T.StringType())

DOC_DETAILS = T.StructType(
    [T.StructField(key, _names) for key in ROLE_KEYS.values()]
    + [T.StructField(key + NORMALIZED_SUFFIX, _names) for key in ROLE_KEYS.values()]
    + [
        T.StructField(SUMMARY_KEY, T.StringType()),
        T.StructField(DATE_KEY, T.StringType()),
        T.StructField(PAGES_KEY, T.IntegerType()),
        T.StructField(DOC_TYPE_KEY, T.StringType()),
        T.StructField(CASE_NO_KEY, T.StringType()),
        T.StructField(EXTRA_KEY, _names),
        T.StructField("Category", T.StringType()),
    ]
)
CASE_DETAILS = T.StructType([T.StructField("Category", T.StringType())])

VERDICT = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("_index", T.StringType()),
        T.StructField("_type", T.StringType()),
        T.StructField("_score", T.IntegerType()),
        T.StructField(
            "_source",
            T.StructType(
                [
                    T.StructField(
                        "doc",
                        T.StructType(
                            [
                                T.StructField("Doc Details", DOC_DETAILS),
                                T.StructField("Case Details", CASE_DETAILS),
                            ]
                        ),
                    ),
                    T.StructField("doc_as_upsert", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("Doc Details", DOC_DETAILS),
        T.StructField("Case Details", CASE_DETAILS),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
