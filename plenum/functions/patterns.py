"""Fixed values that results depend on.

FIXED VALUES — these strings must stay exactly as written so results match
the behaviour being reproduced: regular expressions for meeting minutes,
the required record keys, block tags, the terminator token and the prompt
instruction. Patterns are written for Java regex and avoid look-around so
the same text also runs on RE2 (DuckDB) for the oracle.
"""

# --- FIXED VALUES: meeting header fields ---------------------------------
DAY_RE = r"(?i)\b(Monday|Tuesday|Wednesday|Thursday|Friday)\b"
DATE_RE = (r"(?i)\b((?:January|February|March|April|May|June|July|August|"
           r"September|October|November|December)[\s\p{Z}]+\d{1,2},[\s\p{Z}]+\d{4})\b")
MEET_TYPE_RE = r"(?i)(Regular|Special|Joint) Meeting"
PRESENT_RE = r"(?is)PRESENT:\s*(.+?)(?:\n|$)"
ABSENT_RE = r"(?is)ABSENT:\s*(.+?)(?:\n|$)"
STAFF_RE = r"(?is)STAFF IN ATTENDANCE:\s*(.+?)(?:\n|$)"
LOCATION_WORDS = ["ROOM", "HALL", "BUILDING"]
HEADER_LINES = 20
# a named anchor without href, either quote, any case, other attributes
NAMED_ANCHOR_RE = (r"""(?i)<a\s(?:(?!href\s*=)[^>])*?\bname\s*=\s*["'](\d+_\d{1,2}_\d{2})["']"""
                   r"""(?:(?!href\s*=)[^>])*>(?:\s*</a>)?""")
# weekday, optional comma, month-name date (inference-time meeting date)
HEADER_DATE_RE = (r"(?i)(Monday|Tuesday|Wednesday|Thursday|Friday),?[\s\p{Z}]*"
                  r"((?:January|February|March|April|May|June|July|August|"
                  r"September|October|November|December)[\s\p{Z}]+\d{1,2},[\s\p{Z}]+\d{4})")

# --- FIXED VALUES: block boundaries ---------------------------------------
# case header at line start: 2- or 4-digit year, dot, >=3 digits, suffix,
# then a dash, a colon or whitespace.
CASE_HEADER_RE = (r"(?m)^[ \t]*(?:\d{2}|\d{4})\.\d{3,}(?:[A-Z0-9/]+)?"
                  r"(?:[\s\p{Z}]*[–-][\s\p{Z}]*|[\s\p{Z}]*:[\s\p{Z}]*|[\s\p{Z}]+)")
AGENDA_ITEM_RE = r"(?m)^\s*\d+\.[\s\p{Z}]"
CASE_CODE_RE = r"\b((?:\d{2}|\d{4})\.\d{3,}(?:[A-Z0-9/]+)?)\b"
PROJECT_START = "<<Project Start>>"
PROJECT_END = "<<Project End>>"
BLOCK_RE = r"(?s)<<Project Start>>(.*?)<<Project End>>"
TERMINATOR = "<extra_id_0>"
MISSING_CASE = "<missing case_number>"

# --- FIXED VALUES: modern item parser --------------------------------------
ITEM_HEADER_RE = r"(?m)^(\d{1,2}[a-zA-Z]?\.)\s+(\d{4}-\d{6,}[A-Z]*)"
ADDRESS_RE = r"(\d+ [A-Z\s]+(STREET|AVENUE|BOULEVARD|PLACE|ROAD|DRIVE))"
ACTION_RE = r"ACTION:\s+([^\n]+)"
AYES_RE = r"AYES:\s+([^\n]+)"
NAYS_RE = r"NAYS:\s+([^\n]+)"
BLOCK_ABSENT_RE = r"ABSENT:\s+([^\n]+)"
MOTION_RE = r"(MOTION|RESOLUTION):\s+(\d+)"
SPEAKERS_RE = r"(?s)SPEAKERS:(.*?)(?:ACTION:|AYES:|NAYS:|RESOLUTION:|MOTION:|$)"
SPEAKER_LINE_RE = r"[+=-]\s*[^\n]*"
ITEM_STAFF_RE = r"^\d{1,2}[a-zA-Z]?\.\s+\d{4}-\d{6,}[A-Z]*\s+\((.*?)\)"

# --- FIXED VALUES: record keys -----------------------------------------------
REQUIRED_KEYS = [
    "case_number", "project_address", "lot_number", "assessor_block", "project_descr",
    "type_district", "type_district_descr", "speakers", "action", "modifications",
    "ayes", "noes", "absent", "vote", "action_name",
]
LIST_KEYS = ["ayes", "noes", "absent"]
JOINED_LIST_KEYS = ["speakers", "ayes", "noes", "absent", "modifications"]
FLAT_ORDER = [
    "source_file", "meeting_date", "case_number", "project_address",
    "lot_number", "assessor_block", "project_descr",
    "type_district", "type_district_descr", "action",
    "action_name", "vote", "ayes", "noes", "absent",
    "modifications", "block_header",
]

PROMPT_INSTRUCTION = """You are a strict JSON extractor. Given a block of raw meeting text, extract and return exactly one valid double-quoted JSON object with the keys below (any order). \n\
Only output the JSON—no commentary. Missing fields → empty string "".

Required keys:
- case_number
- project_address
- lot_number
- assessor_block
- project_descr
- type_district
- type_district_descr
- speakers
- action
- modifications
- ayes
- noes
- absent
- vote
- action_name

Raw block:
"""

# --- FIXED VALUES: links -------------------------------------------------------
PAGE_LINK_SUFFIX_RE = r"\.html?$"
URL_RE = r"https?://\S+"
ILLEGAL_NAME_CHARS_RE = r'[\\/*?:"<>|]'
CONTENT_ID = "ctl00_content_Screen"
TABLE_CLASS = "wikitable"

# --- FIXED VALUES: label files -------------------------------------------------
LABEL_FILE_RE = r"(?i)^(\d{4})_labeled\.json$"
