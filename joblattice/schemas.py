"""One explicit schema per table; nothing is inferred from the data."""

from pyspark.sql import types as T

from joblattice.constants import RAW_COLUMNS

STR, INT, LONG, DOUBLE, BOOL, DATE, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampType(),
)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_NAMED = struct(display_name=STR)

HIT = struct(
    id=STR, title=STR, created=STR, description=STR, redirect_url=STR, company=_NAMED, location=_NAMED,
    salary_min=DOUBLE, salary_max=DOUBLE, salary_currency=STR,
)

API_PAGE = struct(query=STR, location=STR, page=INT, results=T.ArrayType(HIT))

RAW_JOBS = struct(**dict.fromkeys(RAW_COLUMNS, STR))

CLEAN_JOBS = struct(
    job_id=STR, job_title=STR, company_name=STR, location=STR, posted_date=DATE, days_since_posted=INT,
    job_description=STR, skills_required=STR, salary_range=STR, salary_min=LONG, salary_max=LONG,
    has_salary=BOOL, has_skills=BOOL, url=STR, source=STR, search_query=STR,
)

JOBS = T.StructType(CLEAN_JOBS.fields + struct(created_at=TS, updated_at=TS, data_quality_score=DOUBLE).fields)

MODEL_VERSIONS = struct(
    model_version=STR, model_type=STR, vectorizer_path=STR, matrix_path=STR, trained_on_jobs_count=LONG,
    feature_count=LONG, ngram_range=STR, status=STR, created_at=TS, created_by=STR, updated_at=TS,
)

BATCH_RUNS = struct(
    batch_id=STR, batch_date=DATE, stage=STR, status=STR, jobs_collected=LONG, jobs_validated=LONG,
    jobs_enriched=LONG, jobs_vectorized=LONG, jobs_inserted=LONG, jobs_updated=LONG, jobs_failed=LONG,
    error_message=STR, execution_time_seconds=INT, created_at=TS, updated_at=TS, notes=STR,
)
