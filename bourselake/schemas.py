"""Explicit schemas of what is landed, and of the finished record."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _B, _D = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


# fixed values: the listing's keys, and the names that they have in a record, in order
LISTING_KEYS = {
    "disclosureIndex": ("disclosure_index", _L),
    "disclosureId": ("disclosure_id", _S),
    "publishDate": ("publish_date", _S),
    "stockCode": ("stock_code", _S),
    "companyTitle": ("company_title", _S),
    "title": ("title", _S),
    "summary": ("summary", _S),
    "disclosureClass": ("disclosure_class", _S),
    "disclosureType": ("disclosure_type", _S),
    "disclosureCategory": ("disclosure_category", _S),
    "period": ("period", _S),
    "year": ("year", _I),
    "attachmentCount": ("attachment_count", _I),
    "isLate": ("is_late", _B),
    "relatedStocks": ("related_stocks", _S),
    "mkkMemberOid": ("mkk_member_oid", _S),
    "relatedDisclosureOid": ("related_disclosure_oid", _S),
    "isChanged": ("is_changed", _S),
    "hasMultiLanguageSupport": ("has_multi_language_support", _S),
    "donem": ("term", _I),
}
REQUIRED_KEYS = ("disclosureIndex", "disclosureId", "publishDate")

LISTING = T.StructType([T.StructField(k, t) for k, (_, t) in LISTING_KEYS.items()])
LANDED_LISTING = T.StructType([T.StructField("disclosureBasic", LISTING)])

ROWS = T.ArrayType(T.ArrayType(_S))
FIELD = _struct(section=_S, concept=_S, label=_S, value=_S)
PAGE_TABLE = _struct(section=_S, rows=ROWS)
ITEM = _struct(concept=_S, label=_S, member=_S, period_label=_S, period_start=T.DateType(), period_end=T.DateType(), value=_D)
STATEMENT = _struct(statement=_S, currency=_S, consolidation=_S, items=T.ArrayType(ITEM))
ATTACHMENT_TABLE = _struct(page=_I, method=_S, rows=ROWS)
RESULT = _struct(file_type=_S, page_count=_I, ocr_pages=_I, skipped_pages=_I, text=_S, error=_S, tables=T.ArrayType(ATTACHMENT_TABLE))
ATTACHMENT = T.StructType([*_struct(file_id=_S, file_name=_S, url=_S).fields, *RESULT.fields])

_listed = [T.StructField(n, T.TimestampNTZType() if n == "publish_date" else t) for n, t in LISTING_KEYS.values()]
_at = [f.name for f in _listed].index("related_stocks") + 1
RECORD = T.StructType(
    [
        *_listed[:_at],
        T.StructField("url", _S),
        *_listed[_at:],
        *_struct(page_format=_S, fields=T.ArrayType(FIELD), tables=T.ArrayType(PAGE_TABLE), financial_statements=T.ArrayType(STATEMENT), attachments=T.ArrayType(ATTACHMENT), text=_S).fields,
    ]
)

#: What the page helper makes of one page (see sources.pages).
LINK = _struct(pos=_I, url=_S, file_name=_S)
#: An element that a selector marks: where it is, its texts and those beside it, and where it stands.
NODE = _struct(pos=_I, marks=T.ArrayType(_S), css=_S, in_area=_B, text=_S, lines=_S, beside=_S, rows=ROWS, in_cell=_B, row_cells=_I, in_grid=_B, row=_I, within=T.ArrayType(_I))
HEADER = _struct(pos=_I, title=_S, value=_S)
CELL = _struct(table_no=_I, title=_S, row_pos=_I, cell_pos=_I, kind=_S, css=_S, text=_S, text_tr=_S)
PAGE = _struct(links=T.ArrayType(LINK), has_area=_B, is_tagged=_B, has_reports=_B, text=_S, nodes=T.ArrayType(NODE), headers=T.ArrayType(HEADER), cells=T.ArrayType(CELL))
