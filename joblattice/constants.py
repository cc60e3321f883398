"""Default dictionaries, column orders and thresholds.

Everything here is only a default: each operator takes its dictionary as a parameter.
"""

from __future__ import annotations

# --- fixed values: name spaces and default texts -------------------------------------------
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"
DEFAULT_SOURCE = "adzuna"
DEFAULT_CURRENCY = "EUR"
UNKNOWN_COMPANY = "Unknown Company"
UNKNOWN_LOCATION = "Unknown Location"

# --- fixed values: column orders ------------------------------------------------------------
RAW_COLUMNS = [
    "job_id", "job_title", "company_name", "location", "posted_date", "job_description",
    "skills_required", "salary_range", "url", "source", "search_query",
]

CLEAN_COLUMNS = [
    "job_id", "job_title", "company_name", "location", "posted_date", "days_since_posted",
    "job_description", "skills_required", "salary_range", "salary_min", "salary_max",
    "has_salary", "has_skills", "url", "source", "search_query",
]

# Columns an upsert overwrites on a matching key; the others keep their first value.
UPSERT_UPDATE_COLUMNS = [
    "job_title", "company_name", "location", "posted_date", "job_description",
    "skills_required", "salary_range", "salary_min", "salary_max", "has_salary", "has_skills",
    "data_quality_score",
]

# --- fixed values: skill keywords searched as whole words -----------------------------------
SKILL_KEYWORDS = [
    "Python", "Java", "SQL", "R", "Scala", "JavaScript", "TypeScript", "C++", "C#",
    "Spark", "Hadoop", "Kafka", "Airflow", "dbt", "Snowflake", "Databricks",
    "AWS", "Azure", "GCP", "Cloud", "Docker", "Kubernetes",
    "Tableau", "Power BI", "Looker", "Qlik", "Excel",
    "Machine Learning", "Deep Learning", "IA", "NLP", "Computer Vision",
    "ETL", "Data Warehouse", "Data Lake", "Big Data",
    "Pandas", "NumPy", "Scikit-learn", "TensorFlow", "PyTorch",
    "Git", "CI/CD", "Agile", "Scrum", "REST API",
    "PostgreSQL", "MySQL", "MongoDB", "Redis", "Elasticsearch",
    "Jenkins", "Terraform", "Ansible",
]

# --- fixed values: token vocabulary and aliases ---------------------------------------------
SKILL_VOCAB = [
    "python", "sql", "spark", "aws", "docker", "kubernetes", "pandas", "numpy",
    "scikit-learn", "tensorflow", "pytorch", "excel", "hadoop", "scala", "r",
]

SKILL_ALIASES = {
    "scikit": "scikit-learn",
    "sklearn": "scikit-learn",
    "tf": "tensorflow",
    "pytorch": "pytorch",
    "py": "python",
}

# --- fixed values: title dictionaries (order matters) ---------------------------------------
SENIORITY_LEVELS = {
    "senior": "senior", "sr": "senior", "sr.": "senior",
    "lead": "lead", "principal": "principal", "staff": "staff",
    "junior": "junior", "jr": "junior", "jr.": "junior",
    "intern": "intern", "internship": "intern",
    "entry": "entry-level", "entry-level": "entry-level",
    "mid": "mid-level", "mid-level": "mid-level",
    "experienced": "experienced",
}

ROLE_SYNONYMS = {
    "data scientist": "data scientist",
    "data science": "data scientist",
    "machine learning engineer": "ml engineer",
    "ml engineer": "ml engineer",
    "mlops engineer": "mlops engineer",
    "machine learning ops": "mlops engineer",
    "backend engineer": "backend engineer",
    "backend developer": "backend engineer",
    "frontend engineer": "frontend engineer",
    "frontend developer": "frontend engineer",
    "full stack engineer": "full stack engineer",
    "full-stack engineer": "full stack engineer",
    "devops engineer": "devops engineer",
    "data engineer": "data engineer",
    "data pipeline": "data engineer",
    "analyst": "analyst",
    "data analyst": "data analyst",
    "business analyst": "business analyst",
    "analytics engineer": "analytics engineer",
}

# --- fixed values: stages, their counters and their time limits (seconds) ---------------------
STAGES = ["collect", "validate", "enrich", "vectorize", "export"]

STAGE_COUNTER = {
    "collect": "jobs_collected",
    "validate": "jobs_validated",
    "enrich": "jobs_enriched",
    "vectorize": "jobs_vectorized",
    "export": "jobs_inserted",
}

STAGE_SLA_SECONDS = {
    "collect": 300, "validate": 120, "enrich": 300, "vectorize": 360, "export": 180,
}
STAGE_ALERT_SECONDS = {
    "collect": 240, "validate": 90, "enrich": 240, "vectorize": 300, "export": 150,
}
TOTAL_SLA_SECONDS = 900
TOTAL_ALERT_SECONDS = 720

# --- fixed values: model defaults ---------------------------------------------------------------
MAX_FEATURES = 10000
NGRAM_RANGE = (1, 2)
TRIGRAM_THRESHOLD = 0.3
