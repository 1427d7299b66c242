"""Dump layouts, table schemas, keys and references, declared as data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# How the source columns of each dump map to table columns. The third entry
# names the converter (see functions.converters); a trailing * marks a required column.
# Declared in load order, parents before the tables that refer to them.
_DUMPS: dict[str, tuple[str, str]] = {
    "title_basics": (
        "title.basics.tsv.gz",
        """
        tconst          tconst           tconst*
        titleType       title_type       text
        primaryTitle    primary_title    text
        originalTitle   original_title   text
        isAdult         is_adult         boolean
        startYear       start_year       integer
        endYear         end_year         integer
        runtimeMinutes  runtime_minutes  integer
        genres          genres           array
        """,
    ),
    "name_basics": (
        "name.basics.tsv.gz",
        """
        nconst             nconst              nconst*
        primaryName        primary_name        text
        birthYear          birth_year          integer
        deathYear          death_year          integer
        primaryProfession  primary_profession  array
        knownForTitles     known_for_titles    array
        """,
    ),
    "title_ratings": (
        "title.ratings.tsv.gz",
        """
        tconst         tconst          tconst*
        averageRating  average_rating  rating
        numVotes       num_votes       integer
        """,
    ),
    "title_crew": (
        "title.crew.tsv.gz",
        """
        tconst     tconst     tconst*
        directors  directors  array
        writers    writers    array
        """,
    ),
    "title_episode": (
        "title.episode.tsv.gz",
        """
        tconst         tconst          tconst*
        parentTconst   parent_tconst   tconst*
        seasonNumber   season_number   integer
        episodeNumber  episode_number  integer
        """,
    ),
    "title_akas": (
        "title.akas.tsv.gz",
        """
        titleId          title_id           tconst*
        ordering         ordering           integer*
        title            title              text
        region           region             text
        language         language           text
        types            types              array
        attributes       attributes         array
        isOriginalTitle  is_original_title  boolean
        """,
    ),
    "title_principals": (
        "title.principals.tsv.gz",
        """
        tconst      tconst      tconst*
        ordering    ordering    integer*
        nconst      nconst      optional_nconst
        category    category    text
        job         job         text
        characters  characters  json_text
        """,
    ),
}

_KEYS = {
    "name_basics": ("nconst",),
    "title_akas": ("title_id", "ordering"),
    "title_principals": ("tconst", "ordering"),
}

# (column, parent table, parent column)
_REFERENCES = {
    "title_ratings": (("tconst", "title_basics", "tconst"),),
    "title_crew": (("tconst", "title_basics", "tconst"),),
    "title_episode": (
        ("tconst", "title_basics", "tconst"),
        ("parent_tconst", "title_basics", "tconst"),
    ),
    "title_akas": (("title_id", "title_basics", "tconst"),),
    "title_principals": (
        ("tconst", "title_basics", "tconst"),
        ("nconst", "name_basics", "nconst"),
    ),
}

_TYPES = {
    "tconst": T.StringType(),
    "nconst": T.StringType(),
    "optional_nconst": T.StringType(),
    "text": T.StringType(),
    "json_text": T.StringType(),
    "integer": T.IntegerType(),
    "boolean": T.BooleanType(),
    "rating": T.DecimalType(3, 1),
    "array": T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class Field:
    source: str
    target: str
    converter: str
    required: bool

    @property
    def type(self) -> T.DataType:
        return _TYPES[self.converter]


@dataclass(frozen=True)
class Dataset:
    """One dump file and the table it fills."""

    filename: str
    table: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    references: tuple[tuple[str, str, str], ...] = field(default=())

    @property
    def plain_filename(self) -> str:
        return self.filename.removesuffix(".gz")

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(f.target for f in self.fields)

    @property
    def schema(self) -> T.StructType:
        """The target table: the converted columns and ``metadata`` as JSON text."""
        fields = [T.StructField(f.target, f.type) for f in self.fields]
        return T.StructType([*fields, T.StructField("metadata", T.StringType())])


def _dataset(table: str) -> Dataset:
    filename, layout = _DUMPS[table]
    fields = []
    for line in layout.strip().splitlines():
        source, target, converter = line.split()
        fields.append(Field(source, target, converter.rstrip("*"), converter.endswith("*")))
    return Dataset(
        filename, table, tuple(fields), _KEYS.get(table, ("tconst",)), _REFERENCES.get(table, ())
    )


DATASETS: dict[str, Dataset] = {table: _dataset(table) for table in _DUMPS}



def _levels() -> tuple[tuple[Dataset, ...], ...]:
    depth: dict[str, int] = {}
    for table, dataset in DATASETS.items():  # parents come first
        depth[table] = 1 + max((depth[parent] for _, parent, _ in dataset.references), default=-1)
    return tuple(
        tuple(d for d in DATASETS.values() if depth[d.table] == level)
        for level in range(max(depth.values()) + 1)
    )


#: The tables by how far their references reach: each refers to tables of earlier levels only.
LEVELS = _levels()

MESSAGE_QUEUE = (
    """id BIGINT, queue_name STRING, payload STRING, status STRING,
    created_at TIMESTAMP, updated_at TIMESTAMP, attempt_count INT, max_attempts INT,
    available_at TIMESTAMP, processing_started_at TIMESTAMP, completed_at TIMESTAMP,
    failed_at TIMESTAMP, last_error STRING"""
)

EVENT_LOG = (
    "event_type STRING, payload STRING, source_file STRING, created_at TIMESTAMP"
)

PRODUCER_PROGRESS = (
    """source_file STRING, table_name STRING, source_size_bytes BIGINT, source_mtime_ns BIGINT,
    last_line BIGINT, rows_enqueued BIGINT, malformed_rows BIGINT, completed BOOLEAN,
    updated_at TIMESTAMP"""
)

STATUSES = ("pending", "processing", "done", "failed")
