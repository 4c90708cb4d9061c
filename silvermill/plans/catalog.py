"""The eight silver tables made from the two bronze tables."""

from __future__ import annotations

from silvermill.spec import ArraySpec, ColumnSpec, TableSpec

# Table and column names, types, keys, sentinels and the date
# pattern that readers of the silver tables rely on.
NO_CREDIT = "0000000000"
NO_ID = -9999
NO_CODE = "XX"
RELEASE_DATE = "yyyy-M-d"

CAST_ELEMENT = {
    "cast_id": "int",
    "character": "string",
    "credit_id": "string",
    "gender": "int",
    "id": "int",
    "name": "string",
    "order": "int",
}
CREW_ELEMENT = {
    "credit_id": "string",
    "department": "string",
    "gender": "int",
    "id": "int",
    "job": "string",
    "name": "string",
}
NAMED_ID = {"id": "int", "name": "string"}
COUNTRY_ELEMENT = {"iso_3166_1": "string", "name": "string"}
LANGUAGE_ELEMENT = {"iso_639_1": "string", "name": "string"}

MOVIE_COLUMNS = (
    ColumnSpec("movie_id", "string", source="id"),
    ColumnSpec("title", "string"),
    ColumnSpec("budget", "double"),
    ColumnSpec("homepage", "string"),
    ColumnSpec("original_language", "string"),
    ColumnSpec("original_title", "string"),
    ColumnSpec("overview", "string"),
    ColumnSpec("popularity", "float"),
    ColumnSpec("release_date", "date", date_format=RELEASE_DATE),
    ColumnSpec("revenue", "double"),
    ColumnSpec("runtime", "int"),
    ColumnSpec("status", "string"),
    ColumnSpec("tagline", "string"),
    ColumnSpec("vote_average", "float"),
    ColumnSpec("vote_count", "int"),
)
# End of fixed values.


def _credit_table(name: str, element: dict[str, str], fields: tuple[str, ...]) -> TableSpec:
    return TableSpec(
        name=name,
        source="credits",
        columns=(ColumnSpec("movie_id", "string"), ColumnSpec("title", "string")),
        array=ArraySpec(name, element, fields),
        sentinels={"credit_id": NO_CREDIT},
        keys=("credit_id", "movie_id"),
        slice_by=("movie_id",),
    )


def _movie_list(name: str, element: dict[str, str], sentinel: object) -> TableSpec:
    key = next(iter(element))
    return TableSpec(
        name=name,
        source="movies",
        columns=(ColumnSpec("movie_id", "string", source="id"),),
        array=ArraySpec(name, element, tuple(element)),
        sentinels={key: sentinel},
        keys=("movie_id", key),
        slice_by=("movie_id",),
    )


CAST = _credit_table("cast", CAST_ELEMENT, tuple(f for f in CAST_ELEMENT if f != "order"))
CREW = _credit_table("crew", CREW_ELEMENT, tuple(CREW_ELEMENT))
MOVIES = TableSpec(
    name="movies",
    source="movies",
    columns=MOVIE_COLUMNS,
    keys=("movie_id", "original_title"),
    slice_by=("movie_id",),
)
GENRES = _movie_list("genres", NAMED_ID, NO_ID)
KEYWORDS = _movie_list("keywords", NAMED_ID, NO_ID)
PRODUCTION_COMPANIES = _movie_list("production_companies", NAMED_ID, NO_ID)
PRODUCTION_COUNTRIES = _movie_list("production_countries", COUNTRY_ELEMENT, NO_CODE)
SPOKEN_LANGUAGES = _movie_list("spoken_languages", LANGUAGE_ELEMENT, NO_CODE)

CREDITS_TABLES = (CAST, CREW)
MOVIES_TABLES = (
    MOVIES,
    GENRES,
    KEYWORDS,
    PRODUCTION_COMPANIES,
    PRODUCTION_COUNTRIES,
    SPOKEN_LANGUAGES,
)
ALL_TABLES = CREDITS_TABLES + MOVIES_TABLES
