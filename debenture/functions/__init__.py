"""Rules over text as Catalyst column expressions."""

from debenture.functions.extract import bank_mentions, banks, clean_bank_name, coupon, currency, dates, is_valid_bank_name, plausibility_flags, standard_bank, validation_flags
from debenture.functions.text import clean_text, document_sections, find_section, strip_company_suffix

__all__ = ["bank_mentions", "banks", "clean_bank_name", "clean_text", "coupon", "currency", "dates", "document_sections", "find_section", "is_valid_bank_name", "plausibility_flags", "standard_bank", "strip_company_suffix", "validation_flags"]
