"""Companies, register rows, metrics and records over DataFrames."""

from debenture.operators import companies, metrics, records, register
from debenture.operators.records import consolidated, extracted, register_extractor, typed

__all__ = ["companies", "consolidated", "extracted", "metrics", "records", "register", "register_extractor", "typed"]
