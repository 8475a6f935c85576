"""Page streams on Spark: finding PDFs, reading their text, splitting them into their documents."""

from .plans.jobs import extract as extract_pdf
from .plans.jobs import forms_to_sheet, split_records
from .plans.jobs import split as split_pdf
from .sources.files import discover as find_pdf_files

__all__ = ["extract_pdf", "find_pdf_files", "forms_to_sheet", "split_pdf", "split_records"]
