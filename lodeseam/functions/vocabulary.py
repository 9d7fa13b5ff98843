"""Phrase lists, vocabularies and formats that the results depend on, word for word."""

# Fixed values. Document types in order of priority.
TYPE_PHRASES = {
    "marking_scheme": ["marking scheme", "marking schemes", "answer scheme", "answer schemes"],
    "past_paper": ["past paper", "past papers", "question paper", "question papers", "model paper", "model papers", "exam paper", "examination paper"],
    "teacher_guide": ["teacher guide", "teacher guides", "teachers guide", "teacher's guide", "teacher's guides", "teacher guidebook", "teacher guide book"],
    "syllabus": ["syllabus", "curriculum", "විෂය නිර්දේශය"],
    "textbook": ["textbook", "text book", "student book", "පෙළපොත"],
    "workbook": ["workbook", "work book", "worksheet", "වැඩපොත"],
    "lesson": ["lesson note", "lesson notes", "lesson", "tutorial", "study note", "study notes", "notes", "පාඩම්", "සටහන්"],
    "article": ["educational article", "article"],
}
POSITIVE = [
    "textbook", "text book", "teacher guide", "teacher guides", "teacher's guide", "teacher guidebook",
    "syllabus", "curriculum", "lesson", "notes", "study note", "workbook", "worksheet",
    "past paper", "paper", "question paper", "examination", "exam", "marking scheme",
    "marking", "answer scheme", "model paper", "model answer", "resource", "tutorial", "guide",
    "පෙළපොත", "ගුරු මාර්ගෝපදේශ", "විෂය නිර්දේශය", "පාඩම්", "ප්‍රශ්න පත්‍ර", "පසුගිය ප්‍රශ්න පත්‍ර",
    "සටහන්", "වැඩපොත", "උත්තර පත්‍ර",
]
SPECIFIC = [
    "textbook", "text book", "teacher guide", "teacher guides", "teacher's guide", "teacher guidebook",
    "syllabus", "curriculum", "workbook", "worksheet", "past paper", "question paper",
    "marking scheme", "answer scheme", "model paper", "model answer", "lesson note",
    "lesson notes", "study note", "study notes", "examination", "exam", "tutorial",
    "පෙළපොත", "ගුරු මාර්ගෝපදේශ", "විෂය නිර්දේශය", "ප්‍රශ්න පත්‍ර", "පසුගිය ප්‍රශ්න පත්‍ර",
]
NEARBY = [
    "textbook", "text book", "teacher guide", "syllabus", "curriculum", "lesson note",
    "workbook", "worksheet", "past paper", "question paper", "marking scheme",
    "answer scheme", "model paper", "model answer", "පෙළපොත", "විෂය නිර්දේශය",
    "ප්‍රශ්න පත්‍ර", "සටහන්",
]
INFRASTRUCTURE = ["privacy", "privacy policy", "terms", "terms of use", "sitemap", "login", "log in", "register", "registration", "dashboard", "account", "profile"]
NAVIGATION = ["home", "about", "contact"]
LISTING = ["hub", "category", "categories", "tag", "tags", "search", "listing"]
CATEGORY_ROUTES = ["category", "categories", "tag", "tags", "search"]
LISTING_PATHS = ["paper", "note", "notes", "marking", "teacher guides"]
LISTING_ROUTES = ["paper", "note", "notes", "marking", "teacher guides", "notesearch"]
DOCUMENT_EXTENSIONS = ["pdf", "doc", "docx", "ppt", "pptx", "xls", "xlsx", "odt", "rtf"]
FILE_EXTENSIONS = DOCUMENT_EXTENSIONS + ["zip", "rar", "jpg", "jpeg", "png", "gif", "mp4", "mp3"]
GENERIC_ANCHORS = ["view", "download", "open", "read more", "click here", "file"]
DEFAULT_BEFORE_NUMBER = ["grade", "grades", "class"]
DEFAULT_LEVEL_ALIASES = {"O-Level": ["o/l", "ordinary level"], "A-Level": ["a/l", "advanced level"]}
CATALOG_COLUMNS = [
    "doc_id", "title", "subject", "domain", "grade", "education_level",
    "document_type", "source", "source_url", "publication_year", "exam_year",
    "language", "license", "status", "local_filename", "sha256",
    "extraction_method", "ocr_required", "page_count", "quality_score",
    "pipeline_version", "last_processed", "error",
]
STATUSES = ["DISCOVERED", "DOWNLOADED", "EXTRACTED", "CLEANED", "DEDUPLICATED", "VALIDATED", "READY", "DOWNLOAD_FAILED", "EXTRACTION_FAILED", "OCR_FAILED", "QUALITY_FAILED", "DUPLICATE"]
ARTIFACT_STATUSES = ["DOWNLOADED", "EXTRACTED", "CLEANED", "DEDUPLICATED", "VALIDATED", "READY"]
LIFECYCLE = ["DISCOVERED", "DOWNLOADED", "EXTRACTED", "CLEANED", "DEDUPLICATED", "VALIDATED", "READY"]
DOCUMENT_TYPES = [*TYPE_PHRASES, "other"]
ID_FORMAT = "LK-EDU-%06d"
ID_PATTERN = r"^LK-EDU-([0-9]{6,})$"
DECISION_SCHEMA = "discovery-decision-1"
RULE_VERSION = "discovery-0.2"
RUN_SCHEMA = "discovery-run-1"
PILOT_SCHEMA = "pilot-annotations-1"
THRESHOLD = 4
DEFAULT_LIMITS = {
    "max_depth": 3, "max_pages_per_source": 100, "request_delay_seconds": 1.0, "timeout_seconds": 15,
    "max_queue": 1000, "max_requests": 250, "max_seconds": 300.0, "max_retries": 2, "max_retry_wait": 30.0,
}

# Fixed values. The subjects of each domain: (name, aliases, lowest grade, highest grade).
SUBJECTS = {
    "STEM": [
        ("Physics", ["භෞතික විද්‍යාව"], 12, 13), ("Chemistry", ["රසායන විද්‍යාව"], 12, 13),
        ("Biology", ["ජීව විද්‍යාව"], 12, 13), ("Science", ["විද්‍යාව"], 6, 11),
    ],
    "Humanities": [
        ("History", ["ඉතිහාසය"], 6, 13), ("Drama and Theatre", [], 6, 13), ("Dancing", [], 6, 13), ("Eastern Music", [], 6, 13),
        ("Buddhism", [], 6, 13), ("Catholicism", [], 6, 13), ("Christianity", [], 6, 13), ("Islam", [], 6, 13),
        ("Buddhist Civilization", [], 6, 13), ("Arts", [], 6, 13), ("Oriental Music", [], 12, 13), ("History of Sri Lanka", [], 12, 13),
        ("Dancing Indigenous", [], 12, 13),
    ],
    "Social Science": [
        ("Geography", ["භූගෝල විද්‍යාව"], 6, 13), ("Political Science", ["දේශපාලන විද්‍යාව"], 12, 13),
        ("Citizenship Education", [], 6, 11), ("Health and Physical Science", [], 6, 11),
    ],
    "Language": [("Sinhala Language and Literature", [], 6, 11), ("Sinhala", [], 12, 13)],
    "Business Studies": [
        ("Business and Accounting Studies", [], 10, 11), ("Economics", ["ආර්ථික විද්‍යාව"], 12, 13),
        ("Business Studies", [], 12, 13), ("Entrepreneurship Studies", [], 10, 11),
    ],
    "Other": [
        ("Home Economics", [], 10, 11), ("Agriculture and Food Technology", [], 10, 11), ("Communication and Media Studies", [], 10, 13),
        ("Design and Construction Technology", [], 10, 11), ("Biosystems Technology", [], 12, 13),
    ],
}
GRADE_MARKERS = {"before_number": ["grade", "grades", "class", "ශ්‍රේණිය"], "after_number": ["ශ්‍රේණිය", "වසර"]}
EDUCATION_LEVELS = {
    "Junior Secondary": {"grade_min": 6, "grade_max": 9},
    "O-Level": {"aliases": ["O/L", "ordinary level", "සාමාන්‍ය පෙළ"], "grade_min": 10, "grade_max": 11},
    "A-Level": {"aliases": ["A/L", "advanced level", "උසස් පෙළ"], "grade_min": 12, "grade_max": 13},
}


def default_taxonomy() -> dict:
    """The taxonomy in the shape of its configuration file."""
    domains = {d: {"subjects": [{"name": n, "aliases": a, "grade_min": lo, "grade_max": hi} for n, a, lo, hi in rows]} for d, rows in SUBJECTS.items()}
    return {"domains": domains, "grade_markers": GRADE_MARKERS, "education_levels": EDUCATION_LEVELS}
