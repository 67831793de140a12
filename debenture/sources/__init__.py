"""Reading and writing: lists, state, workbooks, PDF folders, pages, records."""

from debenture.sources import files, html, pdf
from debenture.sources.files import CompanySheet, RegisterSearch
from debenture.sources.pdf import document_text

__all__ = ["CompanySheet", "RegisterSearch", "document_text", "files", "html", "pdf"]
