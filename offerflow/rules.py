"""Rule tables of the offer engine: fixed values, kept as plain data.

Order matters everywhere in this module: ties between labels go to the label
declared first, and patterns are tried in the order in which they are listed.
"""

from __future__ import annotations

# ---------------------------------------------------------------- sources
# Raw table name -> tag stored with every consolidated offer.
SOURCE_TAGS = {
    "emplois": "emploi",
    "senjobs": "senjob",
    "emploi_expatdakar": "emploi_expatDakar",
    "jobs_emploi_senegal": "emploi_senegal",
    "concoursn_stages": "concoursn_stages",
}

# ----------------------------------------------------------------- salary
# Currency words after an amount, amount rules, factors.
AMOUNT_CURRENCIES = r"(?:fcfa|cfa|€|\$|xof|eur|usd)"
# Not fixed values: the currency and period patterns are merged forms that accept the same texts as the separate
# ones, which the tests list.
CURRENCY_PATTERNS = {
    "XOF": r"[\d\s](?:(?:francs?|f)?\s*cfa|xof)|(?:cfa|xof)[\d\s,]",
    "EUR": r"[\d\s](?:€|eur)|(?:€|eur)[\d\s,]",
    "USD": r"[\d\s](?:\$|usd|dollar)|(?:\$|usd)[\d\s,]",
    "GBP": r"[\d\s](?:£|gbp|livre)|(?:£|gbp)[\d\s,]",
}
DEFAULT_CURRENCY = "XOF"
PERIOD_PATTERNS = {
    "monthly": r"(?:par\s*|/)mois|mensuel|monthly",
    "yearly": r"(?:par\s*|/)an|annuel|yearly|annual",
    "hourly": r"(?:par\s*|/)heure|horaire|hourly|/h",
    "daily": r"(?:par\s*|/)jour|journalier|quotidien|daily",
}
DEFAULT_PERIOD = "monthly"
HOURS_PER_MONTH = 160
DAYS_PER_MONTH = 22
MONTHS_PER_YEAR = 12
EUR_TO_XOF = 655.957
USD_TO_XOF = 600
GBP_TO_XOF = 750
PLAUSIBLE_MONTHLY_XOF = (50_000, 5_000_000)
SALARY_WORDS = "(?:salaire|salaire de|rémunération|rémunéré à|rémunéré de)"

# --------------------------------------------------------------- contract
# Keywords per contract type (a repeated keyword counts twice).
CONTRACT_KEYWORDS = {
    "CDI": (
        "cdi", "contrat à durée indéterminée", "contrat a duree indeterminee", "contrat à durée indéterminée",
        "permanent contract", "full-time permanent", "emploi permanent", "poste permanent", "contrat permanent",
    ),
    "CDD": (
        "cdd", "contrat à durée déterminée", "contrat a duree determinee", "contrat à durée déterminée",
        "fixed-term contract", "temporary contract", "contrat temporaire", "contrat de remplacement",
        "mission temporaire",
    ),
    "Stage": (
        "stage", "stagiaire", "internship", "intern", "alternance", "apprentissage", "formation en alternance",
        "contrat de professionnalisation",
    ),
    "Freelance": (
        "freelance", "freelancer", "independent", "indépendant", "consultant", "consultant externe", "prestataire",
        "sous-traitant", "contractor",
    ),
    "Intérim": (
        "intérim", "intérimaire", "temporaire", "temporary", "mission ponctuelle", "travail temporaire",
        "agence d'intérim",
    ),
    "Contrat Pro": (
        "contrat pro", "contrat de professionnalisation", "alternance", "apprentissage", "formation professionnelle",
    ),
}
# Fallback hints; a type is inferred from two hints on.
CONTRACT_HINTS = {
    "Stage": ("stagiaire", "stage", "apprentissage", "alternance", "étudiant", "université", "école", "formation"),
    "Freelance": (
        "prestation", "mission", "consultant", "expert", "autonome", "indépendant", "facturation", "taux journalier",
    ),
    "Intérim": ("intérim", "remplacement", "congé", "maladie", "mission ponctuelle"),
}
CONTRACT_HINTS_NEEDED = 2
DEFAULT_CONTRACT = "CDI"
# Remote and working-time words.
REMOTE_WORDS = (
    "télétravail", "teletravail", "remote", "work from home", "home office", "à distance", "a distance",
    "remote work", "fully remote", "100% remote", "hybrid", "télétravail partiel", "remote partiel",
)
FULL_TIME_WORDS = (
    "temps plein", "full time", "full-time", "40h", "39h", "heures plein", "full time equivalent", "fte",
    "travail à plein temps",
)
PART_TIME_WORDS = (
    "temps partiel", "part time", "part-time", "mi-temps", "mi temps", "20h", "25h", "30h",
    "travail à temps partiel",
)
# Plausible monthly XOF range per contract type.
CONTRACT_SALARY_RANGES = {
    "CDI": (150_000, 2_000_000),
    "CDD": (120_000, 1_500_000),
    "Stage": (0, 150_000),
    "Freelance": (200_000, 5_000_000),
    "Intérim": (100_000, 800_000),
    "Contrat Pro": (80_000, 300_000),
}
MAX_CONTRACT_RECOMMENDATIONS = 3

# -------------------------------------------------------------- semantics
# Keywords per sector, category, level and job type.
SECTOR_KEYWORDS = {
    "IT/Tech": ("informatique", "technologie", "développeur", "programmeur", "software", "web", "mobile", "data"),
    "Finance": ("finance", "comptabilité", "banque", "audit", "comptable"),
    "Marketing": ("marketing", "communication", "publicité", "digital marketing"),
    "Sales": ("vente", "commercial", "sales", "business development"),
    "HR": ("ressources humaines", "rh", "recrutement", "hr"),
    "Engineering": ("ingénieur", "engineering", "civil", "mécanique", "électrique"),
    "Healthcare": ("santé", "médical", "infirmier", "docteur", "pharmacie"),
    "Education": ("éducation", "enseignant", "professeur", "formation"),
    "Logistics": ("logistique", "supply chain", "transport", "warehouse"),
    "Customer Service": ("service client", "customer service", "support client"),
}
CATEGORY_KEYWORDS = {
    "Développeur": ("développeur", "developer", "programmeur", "coder"),
    "Chef de projet": ("chef de projet", "project manager", "pm"),
    "Ingénieur": ("ingénieur", "engineer", "technical lead"),
    "Commercial": ("commercial", "sales", "account manager"),
    "Marketing": ("marketing", "marketeer", "cmo"),
    "Data Scientist": ("data scientist", "data analyst", "data engineer"),
    "Designer": ("designer", "ui", "ux", "graphiste"),
    "Support": ("support", "helpdesk", "technicien"),
    "Manager": ("manager", "directeur", "responsable"),
}
LEVEL_KEYWORDS = {
    "Junior": ("junior", "débutant", "entry level", "stagiaire", "alternant"),
    "Senior": ("senior", "expérimenté", "confirmé", "lead"),
    "Lead": ("lead", "chef", "manager", "directeur", "responsable"),
    "Expert": ("expert", "spécialiste", "consultant senior"),
}
JOB_TYPE_KEYWORDS = {
    "Full-time": ("temps plein", "full time", "cdi", "contrat à durée indéterminée"),
    "Part-time": ("temps partiel", "part time"),
    "Contract": ("cdd", "contrat à durée déterminée", "freelance", "consultant"),
    "Internship": ("stage", "stagiaire", "alternance"),
    "Remote": ("télétravail", "remote", "à distance", "home office"),
}
# Sentiment lexicon and scale.
POSITIVE_WORDS = (
    "bon", "excellente", "excellent", "réussite", "avantage", "opportunité", "optimisé", "proactif", "solide",
    "motivé", "flexible",
)
NEGATIVE_WORDS = ("mauvais", "problème", "difficile", "urgent", "stress", "risque", "limité", "fragile", "faible")
SENTIMENT_WORD_SHARE = 0.02
MAX_EXPERIENCE_YEARS = 30
SEMANTIC_FIELD_COUNT = 7.0
EMPTY_TEXT_CONFIDENCE = 0.8

# ----------------------------------------------------------------- skills
# Technical terms per category, then soft skills.
TECHNICAL_SKILLS = {
    "Programming Languages": (
        "python", "java", "javascript", "typescript", "c++", "c#", "php", "ruby", "go", "rust", "swift", "kotlin",
        "scala", "r", "matlab", "sql", "html", "css", "sass", "less",
    ),
    "Frameworks & Libraries": (
        "react", "angular", "vue", "next.js", "nuxt.js", "django", "flask", "spring", "laravel", "rails", "express",
        "node.js", "jquery", "bootstrap", "tailwind", "material-ui", "redux", "mobx", "graphql", "rest api",
        "fastapi", "pandas", "numpy", "scikit-learn",
    ),
    "Databases": (
        "mysql", "postgresql", "mongodb", "redis", "elasticsearch", "cassandra", "oracle", "sql server", "sqlite",
        "firebase", "dynamodb", "neo4j", "influxdb",
    ),
    "Cloud & DevOps": (
        "aws", "azure", "gcp", "docker", "kubernetes", "jenkins", "gitlab ci", "github actions", "terraform",
        "ansible", "chef", "puppet", "prometheus", "grafana", "elk stack", "microservices", "ci/cd", "devops",
        "agile", "scrum",
    ),
    "Data Science & ML": (
        "machine learning", "deep learning", "neural networks", "tensorflow", "pytorch", "keras", "opencv", "nlp",
        "computer vision", "data mining", "statistical analysis", "a/b testing", "feature engineering",
        "model deployment", "mlflow", "airflow",
    ),
    "Mobile Development": (
        "android", "ios", "react native", "flutter", "ionic", "cordova", "phonegap", "objective-c", "xamarin",
    ),
    "Design & UX": (
        "figma", "adobe xd", "sketch", "photoshop", "illustrator", "invision", "zeplin", "user research",
        "wireframing", "prototyping", "user testing", "design system", "responsive design", "mobile first",
        "accessibility",
    ),
    "Business & Management": (
        "project management", "product management", "business analysis", "strategic planning", "team leadership",
        "budget management", "risk management", "change management", "stakeholder management", "vendor management",
        "quality assurance",
    ),
}
SOFT_SKILLS = (
    "communication", "leadership", "teamwork", "collaboration", "problem solving", "critical thinking", "creativity",
    "adaptability", "time management", "organizational skills", "analytical skills", "interpersonal skills",
    "presentation skills", "negotiation", "conflict resolution", "empathy", "emotional intelligence",
    "stress management", "decision making", "strategic thinking", "innovation", "customer service",
    "relationship building",
)
# Named patterns, without their word boundaries.
NAMED_SKILL_PATTERNS = {
    "cloud_certifications": r"(?:aws|azure|gcp)\s+(?:certified|professional|associate|solutions\s+architect)",
    "microsoft_tools": r"(?:ms\s+office|microsoft\s+(?:word|excel|powerpoint|outlook|teams))",
    "project_methodologies": r"(?:agile|scrum|kanban|waterfall|lean|six\s+sigma)",
    "spoken_languages": r"(?:fran[cç]ais|anglais|arabe|espagnol|allemand|portugais)"
                        r"\s+(?:courant|bilingue|natif|avanc[eé]|interm[eé]diaire)",
    "certifications": r"(?:pmp|mba|phr|sphr|itil|six\s+sigma|iso\s+\d+)",
}
# First ASCII tokens with which the matches of a named pattern start.
NAMED_SKILL_HEADS = {
    "cloud_certifications": ("aws", "azure", "gcp"),
    "microsoft_tools": ("ms", "microsoft"),
    "project_methodologies": ("agile", "scrum", "kanban", "waterfall", "lean", "six"),
    "spoken_languages": ("francais", "anglais", "arabe", "espagnol", "allemand", "portugais"),
    "certifications": ("pmp", "mba", "phr", "sphr", "itil", "six", "iso"),
}
# Label <- phrases that trigger it.
CONTEXT_SKILLS = {
    "Gestion de projet": ("gestion de projet", "project management", "management de projet"),
    "Analyse de données": ("analyse de données", "data analysis", "analyse des données"),
    "Développement web": ("développement web", "web development", "développement frontend", "développement backend"),
    "Business Intelligence": ("business intelligence", "intelligence d'affaires"),
    "Sécurité informatique": ("cybersécurité", "sécurité informatique", "pentest"),
    "Cloud computing": ("cloud computing", "infrastructure cloud"),
    "Machine Learning": ("machine learning", "apprentissage automatique"),
    "Big Data": ("big data", "données massives", "data engineering"),
    "DevOps": ("devops", "infrastructure as code"),
    "Mobile Development": ("développement mobile", "mobile development", "mobile app"),
}
GENERIC_SKILL_TERMS = ("skill", "competence", "ability", "capacité", "capacite")
SKILL_LENGTHS = (2, 60)
CONTEXT_ONLY_SCORE = 0.1
MAX_SKILLS = 50

# ------------------------------------------------------------------ dates
# French month abbreviations as cut to four letters.
MONTHS_SHORT_FR = {
    "janv": 1, "févr": 2, "fevr": 2, "mars": 3, "avr": 4, "mai": 5, "juin": 6, "juil": 7,
    "août": 8, "aout": 8, "sept": 9, "oct": 10, "nov": 11, "déc": 12, "dec": 12,
}
# Month names read by the absolute form of relative dates (no process locale in Spark).
MONTHS_LONG = {
    "janvier": 1, "february": 2, "février": 2, "january": 1, "mars": 3, "march": 3, "avril": 4, "april": 4,
    "mai": 5, "may": 5, "juin": 6, "june": 6, "juillet": 7, "july": 7, "août": 8, "august": 8,
    "septembre": 9, "september": 9, "octobre": 10, "october": 10, "novembre": 11, "november": 11,
    "décembre": 12, "december": 12,
}

# -------------------------------------------------------------- imputation
# Columns that imputation fills, in order, and thresholds.
TARGET_COLUMNS = (
    "extracted_sector", "extracted_contract_type", "job_level", "job_type",
    "extracted_skills", "extracted_salary_min", "extracted_salary_max",
)
ML_TARGETS = TARGET_COLUMNS[:4]
MIN_CONFIDENCE = 0.7
MIN_COMPLETE_ROWS = 50
VALIDATION_SHARE = 0.2
SPLIT_SEED = 42
NO_TEXT = "Aucune description"

# ------------------------------------------------------------- key phrases
# Stop words that end a candidate phrase (French and English function words).
STOP_WORDS = (
    "a", "à", "ai", "as", "au", "aux", "avec", "ce", "ces", "cette", "dans", "de", "des", "du", "elle", "en", "est",
    "et", "il", "la", "le", "les", "leur", "nous", "ont", "ou", "où", "par", "pas", "pour", "qui", "que", "se", "sa",
    "ses", "son", "sur", "un", "une", "vous", "y", "an", "and", "are", "at", "be", "by", "for", "from", "has", "in",
    "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with", "your",
)
MAX_PHRASE_WORDS = 4
MAX_KEY_PHRASES = 10
