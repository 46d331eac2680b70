"""Feed documents as DataFrames.

A document frame has four columns: ``request_key`` (the date, game id or player
id the document was asked for), ``feed_date`` (the day whose score feed listed
it), ``doc`` (the document under an explicit schema) and ``is_broken`` (the text
is no JSON object). Documents come from a landing zone of files

    <root>/<feed>/feed_date=<yyyy-mm-dd>/<request key>.json
    <root>/player/<request key>.json

or from a table with one JSON text per row, which suits many small documents
better. Only declared fields are read; absent ones are NULL. Numbers may stand as
numbers or as text, whole ones also as ``12.0``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rinkframe.functions import coerce

_TEAM = "STRUCT<id: BIGINT, abbrev: STRING, score: BIGINT>"
_TEXT = "STRUCT<default: STRING>"
_GAME = f"""
    id: BIGINT, season: BIGINT, gameType: INT, gameDate: STRING, venue: {_TEXT},
    startTimeUTC: STRING, easternUTCOffset: STRING, venueUTCOffset: STRING,
    gameState: STRING, homeTeam: {_TEAM}, awayTeam: {_TEAM}"""
_DETAILS = """STRUCT<
    xCoord: DOUBLE, yCoord: DOUBLE, zoneCode: STRING, eventOwnerTeamId: BIGINT,
    shootingPlayerId: BIGINT, goalieInNetId: BIGINT, scoringPlayerId: BIGINT,
    assist1PlayerId: BIGINT, assist2PlayerId: BIGINT, hittingPlayerId: BIGINT,
    hitteePlayerId: BIGINT, winningPlayerId: BIGINT, losingPlayerId: BIGINT,
    drawnByPlayerId: BIGINT, servedByPlayerId: BIGINT, committedByPlayerId: BIGINT,
    blockingPlayerId: BIGINT, playerId: BIGINT, shotType: STRING, duration: BIGINT,
    typeCode: STRING, descKey: STRING, homeScore: BIGINT, awayScore: BIGINT>"""
_PLAYER = """STRUCT<
    playerId: BIGINT, position: STRING, sweaterNumber: BIGINT, toi: STRING, goals: BIGINT,
    assists: BIGINT, points: BIGINT, plusMinus: BIGINT, pim: BIGINT, hits: BIGINT,
    blockedShots: BIGINT, shots: BIGINT, faceoffs: BIGINT, faceoffWinningPctg: DOUBLE,
    powerPlayGoals: BIGINT, powerPlayPoints: BIGINT, shorthandedGoals: BIGINT,
    shPoints: BIGINT, powerPlayToi: STRING, shorthandedToi: STRING,
    saveShotsAgainst: VARIANT, saves: BIGINT, shotsAgainst: BIGINT, goalsAgainst: BIGINT,
    savePctg: DOUBLE, evenStrengthShotsAgainst: STRING, powerPlayShotsAgainst: STRING,
    shorthandedShotsAgainst: STRING, evenStrengthGoalsAgainst: BIGINT,
    powerPlayGoalsAgainst: BIGINT, shorthandedGoalsAgainst: BIGINT>"""
_SIDE = f"STRUCT<forwards: ARRAY<{_PLAYER}>, defense: ARRAY<{_PLAYER}>, goalies: ARRAY<{_PLAYER}>>"
_OFFICIALS = "ARRAY<STRUCT<default: STRING, sweaterNumber: STRING>>"

_DDL = {
    "score": f"games ARRAY<STRUCT<{_GAME}>>",
    "standings": """standings ARRAY<STRUCT<
        teamAbbrev: STRUCT<default: STRING, id: BIGINT>,
        teamCommonName: STRUCT<default: STRING, id: BIGINT>,
        teamName: STRUCT<default: STRING>, conferenceName: STRING, divisionName: STRING,
        gamesPlayed: BIGINT, wins: BIGINT, losses: BIGINT, otLosses: BIGINT, points: BIGINT,
        goalFor: BIGINT, goalAgainst: BIGINT, goalDifferential: BIGINT,
        regulationWins: BIGINT, regulationPlusOtWins: BIGINT>>""",
    "boxscore": f"""id BIGINT, gameDate STRING, homeTeam STRUCT<id: BIGINT>,
        awayTeam STRUCT<id: BIGINT>,
        playerByGameStats STRUCT<homeTeam: {_SIDE}, awayTeam: {_SIDE}>""",
    "play_by_play": f"""id BIGINT, gameDate STRING, season BIGINT, gameType INT,
        homeTeam STRUCT<id: BIGINT, abbrev: STRING>,
        awayTeam STRUCT<id: BIGINT, abbrev: STRING>,
        plays ARRAY<STRUCT<eventId: BIGINT, sortOrder: BIGINT, typeDescKey: STRING,
            periodDescriptor: STRUCT<number: INT, periodType: STRING>,
            timeInPeriod: STRING, timeRemaining: STRING, situationCode: STRING,
            details: {_DETAILS}>>""",
    "shift_charts": """data ARRAY<STRUCT<gameId: STRING, playerId: STRING, teamId: STRING,
        period: STRING, shiftNumber: VARIANT, startTime: STRING, endTime: STRING>>""",
    "right_rail": f"gameInfo STRUCT<referees: {_OFFICIALS}, linesmen: {_OFFICIALS}>",
    "landing": f"{_GAME}, gameOutcome: STRUCT<lastPeriodType: STRING>",
    "player": """playerId BIGINT, firstName STRUCT<default: STRING>,
        lastName STRUCT<default: STRING>, position STRING, sweaterNumber BIGINT,
        currentTeamAbbrev STRING, shootsCatches STRING, birthDate STRING,
        birthCountry STRING, heightInInches BIGINT, weightInPounds BIGINT, headshot STRING,
        seasonTotals ARRAY<STRUCT<season: BIGINT, leagueAbbrev: STRING, gameTypeId: INT,
            goals: BIGINT, assists: BIGINT, points: BIGINT, plusMinus: BIGINT, pim: BIGINT,
            hits: BIGINT, blockedShots: BIGINT, shots: BIGINT>>""",
}

_WHOLE = (T.LongType(), T.IntegerType())

FEEDS = tuple(_DDL)
DATE_FEEDS = ("score", "standings")
GAME_FEEDS = ("play_by_play", "shift_charts", "boxscore", "right_rail", "landing")
_BROKEN = "_broken_text"


def feed_schema(feed: str) -> T.StructType:
    """Declared fields of one feed."""
    return T.StructType.fromDDL(_DDL[feed])


def _with_items(kind: T.DataType, only: tuple[str, ...], inside: bool = False) -> T.DataType:
    """A declared type whose list items keep, of their plain fields, those in ``only``.

    Structs and lists all stay, with one plain field at least, so that a document is
    read, typed or broken just as under the whole type.
    """
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_with_items(kind.elementType, only, True))
    if not isinstance(kind, T.StructType):
        return kind
    nested = (T.StructType, T.ArrayType)
    kept = [f for f in kind if not inside or f.name in only or isinstance(f.dataType, nested)]
    return T.StructType([
        T.StructField(f.name, _with_items(f.dataType, only, inside)) for f in kept or kind[:1]])


def _as_text(kind: T.DataType) -> T.DataType:
    """A declared type with its numbers read as text, in whatever form they stand."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    return T.StringType() if kind in _WHOLE or kind == T.DoubleType() else kind


def _typed(value: Column, kind: T.DataType) -> Column:
    """A value that was read by ``_as_text``, in its declared type."""
    if _as_text(kind) == kind:
        return value
    if isinstance(kind, T.StructType):
        fields = F.struct(*(_typed(value[f.name], f.dataType).alias(f.name) for f in kind))
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    if kind in _WHOLE:
        return coerce.whole_number(value, kind.simpleString())
    return value.try_cast(kind)


def _document(schema: T.StructType, prefix: str) -> Column:
    return F.struct(*(_typed(F.col(f"{prefix}`{f.name}`"), f.dataType).alias(f.name) for f in schema))


def _once(value: Column) -> Column:
    """A value behind a row of its own, so that steps that read it often find it computed.

    Without it the optimizer copies a struct's expressions to every place that reads a
    field, and a list of many fields is typed anew for each.
    """
    return F.explode(F.array(value))


def _broken(fields: list[str], prefix: str) -> Column:
    """The reader kept the text, and not a single declared field could be read."""
    nothing = F.col(f"{prefix}`{_BROKEN}`").isNotNull()
    for f in fields:
        nothing = nothing & F.col(f"{prefix}`{f}`").isNull()
    return nothing


def _day_folders(spark: SparkSession, base: str, start: str, end: str) -> list[str]:
    """Folders of the days in the closed range that were landed.

    Only the names of the day folders are listed, so the cost of opening a chunk
    does not grow with the files of other days.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
    days = sorted(n for n in names if n.startswith("feed_date="))
    return [f"{base}/{n}" for n in days if start <= n.removeprefix("feed_date=") <= end]


def read_feed(
    spark: SparkSession,
    root: str,
    feed: str,
    start: str | None = None,
    end: str | None = None,
    named: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """Documents of one feed in a landing zone, dates inclusive.

    With a date range only the folders of its days are opened; with ``named``, a list of
    days and request keys that have landed, only these files, without listing any folder.
    A document that is no JSON keeps its row with ``is_broken``.
    """
    schema = feed_schema(feed)
    by_date = feed != "player"
    declared = T.StructType(list(_as_text(schema))).add(_BROKEN, T.StringType())
    if by_date:
        declared = declared.add("feed_date", T.DateType())
    base = f"{root.rstrip('/')}/{feed}"
    if named is not None:
        paths = [f"{base}/feed_date={day}/{key}.json" for day, key in named]
    else:
        paths = [base] if start is None else _day_folders(spark, base, start, end)
    if paths:
        docs = (
            spark.read.schema(declared)
            .option("multiLine", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _BROKEN)
            .option("pathGlobFilter", "*.json")
            .option("basePath", base)
            .json(paths)
        )
        key = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.json$", 1)
    else:
        docs, key = spark.createDataFrame([], declared), F.lit("")
    return docs.select(
        key.alias("request_key"),
        (F.col("feed_date") if by_date else F.lit(None).cast("date")).alias("feed_date"),
        _once(F.struct(
            _document(schema, "").alias("doc"),
            _broken(schema.names, "").alias("is_broken"),
        )).alias("read"),
    ).select("request_key", "feed_date", "read.doc", "read.is_broken")


def parse_documents(
    texts: DataFrame, feed: str, text: str = "payload", items: tuple[str, ...] | None = None,
) -> DataFrame:
    """Documents held as JSON text in a column.

    ``texts`` has ``request_key``, ``feed_date`` and the text; other columns are
    dropped. A null or blank text is a broken document. ``items`` names the plain fields
    of list items to read, for readers that need few of them; all without it.
    """
    schema = feed_schema(feed)
    if items is not None:
        schema = _with_items(schema, items)

    def parsed(fields) -> Column:
        declared = T.StructType(list(fields)).add(_BROKEN, T.StringType())
        return F.from_json(
            F.col(text), declared,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN},
        )

    blank = F.coalesce(F.trim(F.col(text)) == "", F.lit(True))
    # Most documents fit the declared types as they stand; the others are read as text.
    exact = texts.select("request_key", "feed_date", text, parsed(schema).alias("exact"))
    fits = F.col(f"exact.`{_BROKEN}`").isNull()
    both = exact.select(
        "request_key", "feed_date", "exact", blank.alias("blank"), fits.alias("fits"),
        F.when(~fits, parsed(_as_text(schema))).alias("loose"))
    doc = F.struct(*(
        F.when(F.col("fits"), F.col(f"exact.`{f.name}`"))
        .otherwise(_typed(F.col(f"loose.`{f.name}`"), f.dataType)).alias(f.name) for f in schema))
    return both.select(
        "request_key",
        "feed_date",
        _once(F.struct(
            doc.alias("doc"),
            (F.col("blank") | _broken(schema.names, "loose.")).alias("is_broken"),
        )).alias("read"),
    ).select("request_key", "feed_date", "read.doc", "read.is_broken")


def dates_between(start: Column, end: Column) -> Column:
    """Every date of a chunk, both ends included."""
    return F.explode(F.sequence(start, end))


def id_list(text: Column) -> Column:
    """Ids of a comma-separated text, one per row; blanks are dropped."""
    items = F.transform(F.split(text, ","), lambda x: F.trim(x))
    return F.explode(F.transform(F.filter(items, lambda x: x != ""), lambda x: x.cast("bigint")))
