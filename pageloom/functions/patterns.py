"""Patterns that decide what a page is, in Java's dialect.

Fixed values: they must match what forms in use print.  WS is every character that Python's str.isspace() accepts;
(?d) keeps the dot from stopping at a carriage return.
"""

WS = r"[\s\x1c-\x1f\x85\p{Z}]"
NOT_WS = r"[^\s\x1c-\x1f\x85\p{Z}]"

DOC_MARKER = rf"(?i)\bDOCUMENT{WS}+\d+{WS}+OF{WS}+\d+\b"
BARE_PAGE = rf"(?i)^Page{WS}+\d+$"
PAGE_ONE_OF = rf"(?i)\bPage{WS}*1{WS}*of{WS}*\d+\b"
PAGE_N_OF_M = rf"(?i)Page{WS}+(\d+){WS}+of{WS}+(\d+)"
DT_FOOTER = rf"(?i)\bDT{WS}*\d"
INCOMPLETE_NOTICE = rf"(?i)INCOMPLETE{WS}+APPLICATIONS{WS}+WILL{WS}+NOT{WS}+BE{WS}+PROCESSED"
ROUTEONE = r"(?i)RouteOne"
TITLE_SKIP = rf"(?i)FORM{WS}+NO\.|[:(#@©()]|\b(?:LLC|INC|CORP|LTD|INCORPORATED)\b"
SECTION_HEADER = rf"^(?:[A-Za-z]|\d+)\.{WS}"
DATE_SEEN = r"\d{1,2}/\d{1,2}/\d{4}"
PHONE_LIKE = rf"[+(]?\d(?:\d|{WS}|[-().]){{7,}}\d"

RO_APPLICANT = rf"(?id)Credit Application:{WS}*Applicant{WS}*\n(.+)"
RO_PERSON_TITLE = rf"(?i)^(?:Mrs?|Miss|Ms|Dr)\.?{WS}*"
RO_PHONES = rf"(?isd)at the following telephone number\(s\):{WS}*(.+?)\."
RO_CONSENT = rf"(?isd)Optional Consent.*?Applicant:{WS}*By{WS}+Date(.*?)(?:Source:|$)"
DT_NAME = rf"(?md)^([A-Z]{{2,}}){WS}+([A-Z]{{2,}}){WS}+\d{{3}}-\d{{2}}-\d{{4}}"
DT_PHONES = r"(?isd)at the following number\(s\)(.*?)(?:including any cell phone numbers|You understand)"

NOT_IN_FILE_NAMES = r'[<>:"/\\|?*]+'
#: One or several: what is between two of them is an empty line.
LINE_ENDS = "[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]+"
WATERMARK = "non-authoritative copy"
CREDIT_APPLICATION = "Credit Application"
CREDIT_APPLICATION_FILE = "Credit_Application.pdf"
CHECKBOX_TEXT = "You opt in"

#: A page with fewer characters is taken for an image.
TEXT_PAGE_CHARS = 50
TITLE_MIN_CHARS, TITLE_MAX_CHARS = 4, 60
TITLE_MIN_SCORE = 50.0
