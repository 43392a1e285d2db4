"""Table schemas and the fixed vocabulary of the data model."""

from pyspark.sql import types as T

# Processing statuses, in order; FAILED stands outside the order.
STATUSES = (
    "DISCOVERED",
    "DOWNLOADING",
    "UPLOADED",
    "CHUNKING",
    "CHUNKED",
    "EMBEDDING",
    "INDEXED",
    "FAILED",
)
# Statuses at which the tender's archive is in storage.
ARCHIVED_STATUSES = ("UPLOADED", "CHUNKING", "CHUNKED", "EMBEDDING", "INDEXED")
# Outcome of one file of an archive.
FILE_STATUSES = ("chunked", "skipped", "failed")

IDENTITY = ["tender_id", "organization_acronym"]


LONG, INT, TEXT, DAY, INSTANT = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.DateType(),
    T.TimestampType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Names and order of the columns of all tables below.
_FIELDS = {
    "tender_id": TEXT,
    "organization_acronym": TEXT,
    "procurement_type": TEXT,
    "category": TEXT,
    "publication_date": DAY,
    "reference_number": TEXT,
    "tender_object": TEXT,
    "public_buyer": TEXT,
    "location": TEXT,
    "deadline": INSTANT,
}

#: The ten fields a result page yields for one tender.
TENDER_FIELDS = _struct(**_FIELDS)

TENDERS = _struct(
    id=LONG, **_FIELDS, status=TEXT, last_status=TEXT, created_at=INSTANT, updated_at=INSTANT
)

DCE_FILES = _struct(
    id=LONG,
    tender_record_id=LONG,
    path=TEXT,
    file_type=TEXT,
    status=TEXT,
    reason=TEXT,
    created_at=INSTANT,
)

CHUNKS = _struct(
    id=LONG,
    dce_file_id=LONG,
    chunk_index=INT,
    text=TEXT,
    page_numbers=T.ArrayType(INT),
    heading_path=T.ArrayType(TEXT),
    embedding_model=TEXT,
    embedding=T.ArrayType(T.FloatType()),
    created_at=INSTANT,
)

STATUS_UPDATES = _struct(
    seq=LONG, tender_id=TEXT, organization_acronym=TEXT, status=TEXT, last_status=TEXT
)

RESULT_PAGES = _struct(page_id=LONG, url=TEXT, html=TEXT)

ARCHIVES = _struct(path=TEXT, content=T.BinaryType())

#: Input of chunking: pieces of a document in order, with their section and page.
BLOCKS = _struct(
    doc_id=LONG, section_no=INT, headings=T.ArrayType(TEXT), page=INT, position=INT, text=TEXT
)
