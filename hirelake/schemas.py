"""Table schemas, value vocabularies and sentinels.

Everything under "fixed values" is data that results depend on, not logic.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("job_url", T.StringType()),
        T.StructField("job_title", T.StringType()),
        T.StructField("company_name", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("salary_raw", T.StringType()),
        T.StructField("tech_stack", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("crawl_timestamp", T.TimestampNTZType()),
        T.StructField("experience_level", T.StringType()),
        T.StructField("job_category", T.StringType()),
        T.StructField("job_description", T.StringType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("job_id", T.StringType()),
        T.StructField("job_url", T.StringType()),
        T.StructField("job_title", T.StringType()),
        T.StructField("min_years_of_experience", T.IntegerType()),
        T.StructField("ai_core_tech_stack", T.StringType()),
        T.StructField("english_requirement", T.StringType()),
        T.StructField("ai_job_role", T.StringType()),
        T.StructField("job_level", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
        T.StructField("last_seen_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
    ]
)

# What an extractor returns for one posting.
EXTRACTION = T.StructType(
    [
        T.StructField("min_years_of_experience", T.IntegerType()),
        T.StructField("core_tech_stack", T.ArrayType(T.StringType())),
        T.StructField("english_requirement", T.StringType()),
        T.StructField("job_role", T.StringType()),
        T.StructField("job_level", T.StringType()),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# --- fixed values -----------------------------------------------------------

# source names: (bronze/intermediate spelling, silver spelling)
SITE_A, SITE_A_SILVER = "ITViec", "ITVIEC"
SITE_B, SITE_B_SILVER = "TopCV", "TOPCV"
SITE_A_HOST = "https://itviec.com"
SITE_B_HOST = "https://www.topcv.vn"

# search keywords in crawl order
KEYWORDS = [
    "data-engineer",
    "data-analyst",
    "data-scientist",
    "analytics-engineer",
    "machine-learning",
    "ai-engineer",
    "business-intelligence",
]

ACTIVE, ERROR, INACTIVE, EXPIRED = "Active", "Error", "Inactive", "Expired"
UNKNOWN = "Unknown"

JD_NOT_FOUND = "JD content not found"
JD_CONNECTION_ERROR = "Connection error"

UNKNOWN_COMPANY = "Unknown company"
UNKNOWN_LOCATION = "Unknown location"
TITLE_ERROR = "Title extraction error"
SALARY_SIGN_IN = "Sign in to view salary"
SALARY_UPDATING = "Updating..."
SALARY_NEGOTIABLE = "Thỏa thuận"
NO_TAGS = "No tags"
TECH_STACK_LATER = "To be extracted by AI"

ENGLISH_NONE = "Not mentioned"
ENGLISH_READING = "Read/Write basic documentations"
ENGLISH_COMMUNICATION = "Communicate with clients"
ENGLISH_CERTIFICATE = "Required certificate (IELTS/TOEIC)"
ENGLISH_LEVELS = [ENGLISH_NONE, ENGLISH_READING, ENGLISH_COMMUNICATION, ENGLISH_CERTIFICATE]

JOB_ROLES = [
    "Backend",
    "Frontend",
    "Fullstack",
    "Mobile",
    "Data Engineer",
    "Data Scientist",
    "Data/Business Analyst",
    "Product Owner/Manager",
    "QA/QC/Tester",
    "DevOps/Cloud",
    "System Admin",
    "UI/UX Designer",
    "Security",
    "Scrum Master",
    "AI/Machine Learning",
    "Unknown",
]

# display order; "Unknown" closes the extraction contract
LEVEL_ORDER = ["Intern", "Fresher", "Junior", "Middle", "Senior", "Manager", "Director"]
JOB_LEVELS = LEVEL_ORDER + [UNKNOWN]

MAX_SKILLS = 5

# one list per canonical skill name: the spellings that map to it (lower case)
SKILL_ALIASES = {
    "Python": ["python"],
    "Java": ["java"],
    "JavaScript": ["javascript", "js"],
    "TypeScript": ["typescript", "ts"],
    "React": ["react", "reactjs", "react.js"],
    "Vue.js": ["vue", "vuejs", "vue.js"],
    "Angular": ["angular", "angularjs"],
    "Node.js": ["node", "nodejs", "node.js"],
    "Go": ["golang"],
    "C++": ["c++"],
    "C#": ["c#"],
    ".NET": [".net", "dotnet"],
    "PHP": ["php"],
    "Laravel": ["laravel"],
    "Django": ["django"],
    "Spring": ["spring", "springboot"],
    "SQL": ["sql"],
    "PostgreSQL": ["postgresql", "postgres"],
    "MySQL": ["mysql"],
    "MongoDB": ["mongodb", "mongo"],
    "Redis": ["redis"],
    "Kafka": ["kafka"],
    "Spark": ["spark", "pyspark"],
    "Airflow": ["airflow"],
    "dbt": ["dbt"],
    "AWS": ["aws"],
    "Azure": ["azure"],
    "GCP": ["gcp"],
    "Docker": ["docker"],
    "Kubernetes": ["kubernetes", "k8s"],
    "Terraform": ["terraform"],
    "Linux": ["linux"],
    "Git": ["git"],
    "Power BI": ["powerbi"],
    "Tableau": ["tableau"],
    "Excel": ["excel"],
    "TensorFlow": ["tensorflow"],
    "PyTorch": ["pytorch"],
    "Flutter": ["flutter"],
    "Kotlin": ["kotlin"],
    "Swift": ["swift"],
    "Selenium": ["selenium"],
    "Figma": ["figma"],
}
