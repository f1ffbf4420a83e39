"""Keyed state of the grade stream: the newest grade of each assessment of an enrolment, and its present outcome, by groups."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lectern.functions.status import BLOCKED, MIN_ATTENDANCE, MIN_GRADE

def mean_of_hundredths(pairs: list[tuple[int | None, int]]) -> int | None:
    """Σ(grade·weight)/Σweight, all in hundredths, half up; as ``aggregates.weighted_mean``, an unknown grade still weighs."""
    known = [v * w for v, w in pairs if v is not None]
    value, weight = sum(known), sum(w for _, w in pairs)
    if not known or not weight:
        return None
    sign = -1 if (value < 0) != (weight < 0) else 1
    value, weight = abs(value), abs(weight)
    # Rounded to 19 places, as a division of these decimals is in Spark, then to two.
    fine = (2 * value * 10**17 + weight) // (2 * weight)
    return sign * ((fine + 5 * 10**16) // 10**17)


def weighted_mean(pairs: list[tuple[Decimal | None, Decimal | None]]) -> Decimal | None:
    """The same of decimals with two places."""
    hundredths = lambda x: None if x is None else int(x.scaleb(2))
    mean = mean_of_hundredths([(hundredths(v), hundredths(w)) for v, w in pairs if w is not None])
    return None if mean is None else Decimal(mean).scaleb(-2)


def derived_status(grade: Decimal | float | None, attendance: Decimal | float | None, old: str | None) -> str | None:
    """As ``status.grade_status_derived``: where neither side can be decided the old status stays."""
    if grade is not None and attendance is not None and grade >= MIN_GRADE and attendance >= MIN_ATTENDANCE:
        return "APROVADA"
    if (grade is not None and grade < MIN_GRADE) or (attendance is not None and attendance < MIN_ATTENDANCE):
        return "REPROVADA"
    return old


def _age(version: tuple) -> list[tuple]:
    """Order of versions (batch, posted, grade); NULLs are the oldest."""
    return [(x is not None, x) if x is not None else (False,) for x in version[:3]]


def _part(x: int | None) -> float | None:
    return None if x is None else x / 100


FIELDS = 6  # of a member, before its grades: identity, known, attendance, grade, status, posted
VERSION = 5  # fields of a grade: assessment, batch, posted, grade, weight


def arriving(grades: DataFrame) -> DataFrame:
    """Accepted grades as the state takes them: one text each, since every cell of a row is fetched by itself."""
    return grades.select("_group", F.to_json(_texts([F.col("MatriculaID"), *_version(F.col)])).alias("grade"))


def _texts(values: Sequence[Column]) -> Column:
    return F.array(*[v.cast("string") for v in values])


def _version(of: Callable[[str], Column]) -> list[Column]:
    """Assessment, batch, time, grade and weight; numbers in hundredths."""
    return [
        of("AvaliacaoID"), of("batch_id").cast("long"), of("LancadaEm").cast("timestamp_ntz"), hundredths(of("NotaObtida")),
        hundredths(of("Peso")),
    ]


def hundredths(value: Column) -> Column:
    return (value.cast("decimal(5,2)") * 100).cast("long")


def member(grades: Column) -> Column:
    """An enrolment of ``initial_grades`` as an array of texts: ``FIELDS`` of its own, then ``VERSION`` for each of its grades."""
    own = [
        F.col("MatriculaID"), F.col("known").cast("int"), hundredths(F.col("FrequenciaPercentual")), hundredths(F.col("NotaFinal")),
        F.col("StatusMatricula"), F.col("posted").cast("timestamp_ntz"),
    ]
    each = lambda grade: _texts(_version(lambda name: grade[name]))
    return F.concat(_texts(own), F.coalesce(F.flatten(F.transform(grades, each)), F.array().cast("array<string>")))


class GradeState(StatefulProcessor):
    """Takes accepted grades (``arriving``) of a group of enrolments and gives the new outcome of each enrolment that has
    some, all in one row (``decoded``).

    A state call goes through a socket and a value of many fields is converted one by one on both sides, so the state
    is held by groups, as one text each: a JSON list of the members (``member``) of
    a group with the newest version of each of their assessments' grades.  A batch
    reads and writes it once, however many members it touches, and the initial rows pass as they are.  A member is as large as its number of
    assessments, however often they are graded again.  The initial rows carry the members with their
    earlier grades.  An enrolment that is in none of them is unknown: its grades are kept, and no outcome is given.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.members = handle.getValueState("members", T.StructType().add("members", "string"))

    def handleInitialState(self, key: tuple, row: Row, timers) -> None:
        self.members.update((row.members,))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers) -> Iterator[Row]:
        now = self.members.get()
        held = {m[0]: m for m in json.loads(now[0])} if now is not None else {}
        grades, touched, outcomes = {}, {}, []
        for owner, assessment, batch, posted, obtained, weight in json.loads(f"[{','.join(r.grade for r in rows)}]"):
            version = [int(batch), posted, _number(obtained), _number(weight)]
            if owner not in grades:
                grades[owner] = _grades(held[owner]) if owner in held else {}
                touched[owner] = False
            old = grades[owner].get(assessment)
            if old is None or _age(version) > _age(old):
                grades[owner][assessment] = version
                touched[owner] = True
        for owner, own in grades.items():
            known, attendance, grade, status, posted = _outcome(held[owner]) if owner in held else (False, None, None, None, None)
            before = (grade, status, posted)
            weighted = [(v[2], v[3]) for v in own.values() if v[3] is not None]
            if known and status is not None and status not in BLOCKED and weighted:
                grade = mean_of_hundredths(weighted)
                status = derived_status(_part(grade), _part(attendance), status)
                posted = max((v[1] for v in own.values() if v[1] is not None), default=None)
            if touched[owner] or (grade, status, posted) != before:
                touched[owner] = True
                versions = [x for a, v in own.items() for x in (a, *v)]
                held[owner] = [owner, int(known), attendance, grade, status, posted, *versions]
            if known:
                outcomes.append([owner, grade if grade is None else str(grade), status, posted])
        if any(touched.values()):
            self.members.update((json.dumps(list(held.values()), separators=(",", ":")),))
        if outcomes:
            yield Row(outcomes=json.dumps(outcomes))

    def close(self) -> None:
        pass


OUTCOMES = "outcomes string"


def decoded(outcomes: DataFrame, enrolment: T.DataType) -> DataFrame:
    """A row for each outcome that ``GradeState`` gives, with the kinds of the tables."""
    each = outcomes.select(F.explode(F.from_json("outcomes", "array<array<string>>")).alias("o"))
    owner, grade, status, posted = (F.get("o", F.lit(n)) for n in range(4))
    return each.select(
        owner.cast(enrolment).alias("MatriculaID"), (grade.cast("decimal(12,0)") / 100).cast("decimal(5,2)").alias("NotaFinal"),
        status.alias("StatusMatricula"), posted.cast("timestamp_ntz").alias("posted"),
    )


def _number(x: str | int | None) -> int | None:
    return None if x is None else int(x)


def _outcome(member: list) -> tuple:
    """(known, attendance, grade, status, posted) of a member."""
    return bool(int(member[1])), _number(member[2]), _number(member[3]), member[4], member[5]


def _grades(member: list) -> dict[str, list]:
    """Assessment to version (batch, posted, grade, weight) of a member."""
    found = {}
    for at in range(FIELDS, len(member), VERSION):
        assessment, batch, posted, grade, weight = member[at : at + VERSION]
        found[assessment] = [_number(batch), posted, _number(grade), _number(weight)]
    return found
