"""Word lists, patterns and constants that results depend on.

Every operator takes these as parameters; the values here are the defaults.
"""

# --- fixed values: identifiers -------------------------------------------------------------
DICTIONARY_ID_PREFIX = "esco_"
TAXONOMY_ID_PREFIX = "cs_"

# --- fixed values: thresholds --------------------------------------------------------------
NEAR_DUPLICATE_RATIO = 90
NEAREST_LABEL_MIN = 0.72
NEAREST_LABEL_MARGIN = 0.02
SEMANTIC_MIN = 0.60
ALIAS_CONFIDENCE = 0.95
MIN_SKILLS_PER_POSTING = 2
MIN_EMPLOYERS = 3
EMPLOYER_SHARE = 0.005
ENTRY_LEVEL_MAX_YEARS = 1
MIN_TOPICS = 3
MIN_PAGE_TEXT = 200
MAX_EVIDENCE = 5
SURVIVAL_STEPS = (1, 2, 3, 5, 8, 10, 15, 20, 30, 50)

# --- fixed values: posting columns, canonical name <- source names in order of preference ----
POSTING_COLUMNS = {
    "employer": ["company_name", "employer", "company"],
    "title": ["job_title", "title"],
    "skills": ["skills_required", "required_skills", "skills"],
    "description": ["job_description", "description"],
    "exp_min": ["experience_min_yrs", "years_experience"],
    "exp_text": ["experience_raw", "experience_level"],
}

# --- fixed values: cells that a CSV reader takes for missing -----------------------------------
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: patterns, all matched without case ------------------------------------------
TITLE_INCLUDE = (
    r"\b(software|developer|programmer|sde|sdet|engineer|engineering|data scientist|"
    r"data engineer|data analyst|analytics engineer|machine learning|ml|ai|genai|"
    r"gen ai|nlp|llm|deep learning|computer vision|devops|mlops|sre|backend|"
    r"back-end|frontend|front-end|full[- ]?stack|python|java|javascript|react|node|"
    r"android|ios|web|cloud|cyber|security|database|dba|automation)\b"
)
TITLE_EXCLUDE = (
    r"\b(civil|mechanical|electrical|electronics?|chemical|hr|human resources?|"
    r"recruit\w*|sales|legal|law|marketing|accountant|accounts?|finance|financial|"
    r"teacher|faculty|payroll|business analyst|process|operations|supply chain|"
    r"procurement|commissioning|site|qc|quality control|officer|executive|"
    r"consultant|content|writer|designer|customer|support|manager|admin\w*|bpo)\b"
)
TITLE_SENIOR = r"\b(senior|sr|lead|principal|staff|head|director|vp|architect|chief|expert)\b"
ENTRY_LEVEL_TEXT = (
    r"(^|\b)(0\s*[-–to]+\s*[12]\s*(years?|yrs?)|fresher|entry[\s-]*level|graduate trainee|EN)(\b|$)"
)
PLACEHOLDER_EMPLOYER = (
    r"(leading client|client of|\bmnc\b|confidential|undisclosed|stealth|"
    r"^company$|^client$|^top .*(company|domain|corporate)|^foreign |^reputed |^leading )"
)
EMPLOYER_SUFFIX = r"\b(pvt|private|ltd|limited|inc|llc|llp|corp|corporation|co|gmbh|plc)\b\.?"
DIGITAL_KEYWORDS = (
    r"\b(python|java|javascript|c\+\+|c#|sql|nosql|html|css|php|scala|rust|golang|"
    r"programming|software|algorithm|database|data (model|mining|warehous|engineer|science|visuali)|"
    r"machine learning|deep learning|neural|artificial intelligence|natural language|"
    r"computer vision|cloud|devops|docker|kubernetes|git|linux|unix|network|cyber|"
    r"security|api|web|framework|debug|test|big data|hadoop|spark|etl|tableau|"
    r"ict|computer|coding|agile|scrum)\b"
)
TITLE_BUILDER = r"\b(?:developer|engineer|sde|programmer|scientist|architect)\b"
TITLE_JUNIOR = (
    r"\b(?:trainee|intern|internship|graduate|entry|junior|jr|associate|support|qa|tester)\b"
)

# --- fixed values: skill strings too vague to map ------------------------------------------------
VAGUE_SKILLS = [
    "data", "development", "management", "analysis", "analytical", "analytics",
    "usage", "training", "research", "focus", "operations", "consulting",
    "workflow", "monitoring", "scalability", "content", "performance", "sales",
    "healthcare", "finance", "customer service", "problem solving", "communication",
    "not available", "na", "n/a", "other", "others", "etc",
]

# --- fixed values: alias -> dictionary label ------------------------------------------------------
SKILL_ALIASES = {
    "nlp": "natural language processing",
    "ml": "machine learning",
    "dl": "deep learning",
    "ai": "principles of artificial intelligence",
    "artificial intelligence": "principles of artificial intelligence",
    "js": "JavaScript",
    "node": "Node.js",
    "nodejs": "Node.js",
    "postgres": "PostgreSQL",
    "k8s": "Kubernetes",
    "dsa": "algorithms",
    "data structures": "algorithms",
}

# --- fixed values: demand depth and trend keywords, tested as substrings of the label ----------------
APPLY_LABELS = [
    "git", "version control", "linux", "unix", "sql", "html & css", "html", "css",
    "jira", "docker", "postman", "rest api", "unit test", "debugging", "shell script",
    "bash", "command line", "agile", "scrum", "sdlc", "ci/cd",
]
BUILD_LABELS = [
    "c++", "c", "java", "python", "algorithms", "data structures",
    "machine learning", "deep learning", "artificial intelligence",
    "software architecture", "computer programming", "backend",
    "object-oriented programming", "develop software prototype",
    "design database scheme", "natural language processing", "computer vision",
    "web programming", "angular", "react", "ajax", "scala",
]
JUNIOR_SHARE_MIN = 0.35
BUILDER_SHARE_MIN = 0.25
RISING_LABELS = ["machine learning", "artificial intelligence", "python", "deep learning", "cloud"]
FADING_LABELS = ["php", "flash", "spreadsheet"]
KEYWORD_MULTIPLIERS = {"rising": (1.35, 1.65), "fading": (0.65, 0.85)}
STEADY_MULTIPLIER = 1.05
RISING_MULTIPLIER = 1.30
BAND = (0.85, 1.15)

# --- fixed values: course vetting -----------------------------------------------------------------
COURSE_PREFIXES = ["CSH", "CST", "CSP", "ECP"]
COURSE_CODE = r"\b\d{2}([A-Z]{3})[-_]?\d{3}\b"
COURSE_NAME = r"Course Name\s*\|?\s*(.+?)\s*Course Code"
NON_GRADED_MARKS = ["Mandatory Non-Graded", "(MNG)"]
BANNED_COURSE_WORDS = [
    "career", "pathway", "values", "ethics", "environmental", "life skills", "soft skills",
    "human rights", "constitution", "gender", "wellness", "mentoring", "universal human",
    "drawing", "workshop", "mechanical", "communication",
]

# --- fixed values: table headers and lesson lines ----------------------------------------------------
HEADER_TOPIC = r"^(topics?|experiment name|experiment title|contents?)$"
HEADER_HOURS = r"\b(?:hou?rs?|hrs?|lectures?|periods?|duration)\b|^l$"
SECTION_ON = ["Lecture Plan Preview", "Experiment Name"]
SECTION_OFF = ["Assessment Model", "CO vs PO"]
UNIT_LINE = r"^unit\s*[-:]?\s*([ivx\d]+)"
SKIP_LINE = (
    r"^(po\d+|peo\d+|pso\d+|mission|vision|sr no|credit|mode of|assessment|mst-|"
    r"practical end|attendance|exam name|co vs po|r-|t-)"
)
LINE_LEVEL = r"CO\d+\s*-\s*BT[1-6]"
LINE_HOURS = r"(\d+)\s*(?:hrs?|hours?)\b"
LINE_NUMBERING = r"^\d+\s+\d+\s+"
LINE_REFERENCES = r"\b[TR]-[A-Za-z0-9\s:,]+"
TOPIC_PREFIX = r"^(unit\s*[-:]?\s*\w+|experiment\s*\d*)\s*[:\-]?\s*"
DEFAULT_HOURS = {"practical": 2, "theory": 1}

# --- fixed values: depth --------------------------------------------------------------------------
DEPTHS = ["know", "apply", "build"]
DEPTH_VERBS = {
    "know": ["define", "describe", "explain", "identify", "list", "state", "understand", "recall",
             "outline", "summarize", "discuss", "study", "recognize", "name", "classify", "know",
             "learn", "introduce", "introduction", "overview", "basics"],
    "apply": ["implement", "use", "apply", "write", "solve", "demonstrate", "execute", "compute",
              "calculate", "perform", "analyze", "compare", "trace", "illustrate", "run", "test",
              "debug", "configure", "install", "simulate", "practice", "create", "insert", "delete"],
    "build": ["design", "develop", "build", "construct", "evaluate", "integrate", "deploy",
              "architect", "optimize", "synthesize", "formulate", "engineer", "propose", "compose",
              "plan", "produce"],
}
USUAL_VERB = {"know": "understand", "apply": "implement", "build": "design"}
