from claimstrata.sources.checked import BAD_LINE, SOURCE_FILE, read_checked, why_bad, without_values
from claimstrata.sources.documents import WIRE_SCHEMA, parse_documents, read_documents
from claimstrata.sources.drift import declared_fields, found_fields, read_variants, undeclared_fields

__all__ = [
    "BAD_LINE",
    "SOURCE_FILE",
    "WIRE_SCHEMA",
    "declared_fields",
    "found_fields",
    "parse_documents",
    "read_checked",
    "read_documents",
    "read_variants",
    "undeclared_fields",
    "why_bad",
    "without_values",
]
