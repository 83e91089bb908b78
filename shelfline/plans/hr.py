"""People master: levelled departments joined to persons, e-mails and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.functions.clean import blank_matching, leading_digit_codes
from shelfline.operators.joins import full_outer
from shelfline.operators.org import Climb, climb, level_columns
from shelfline.operators.rows import keep_first
from shelfline.session import materialise

# New names of department and master columns.
DEPARTMENT_NAMES = {
    "name": "SectionNameJP", "customString1": "SectionNameEN", "customString8": "LCD",
    "externalCode": "SectionCD", "parent": "ParentSectionCD",
}
MASTER_NAMES = {
    "nationality": "Nationality", "gender": "Gender", "customString5": "LastNameJP",
    "customString6": "MiddleNameJP", "customString4": "FirstNameJP", "lastName": "LastNameEN",
    "middleName": "MiddleNameEN", "firstName": "FirstNameEN", "maritalStatus": "Status",
    "emailAddress": "Email", "userId": "EmployeeCode", "managerId": "ManagerEmployeeCode",
    "company": "CompanyCode", "jobCode": "JobCode", "department": "DepartmentCode",
    "jobTitle": "JobTitleEN", "customString2": "JobTitleJP", "customString25": "JobTitleCommonEN",
    "customString24": "JobTitleCommonJP", "name_localized": "SectionNameJP",
    "SectionCD": "SectionCD", "SectionNameEN": "SectionNameEN", "LCD": "LCode",
}
# Levels whose names are blanked where they are only a label.
CLEANED_LEVELS = ("0", "1", "2", "2_5", "3", "4_1", "4_2", "4_3", "4_4")
LEVEL_LABEL = r"\w+[0-9]{1}"
EMPTY = " "


def departments(raw: DataFrame) -> DataFrame:
    """Departments of the current organisation under their new names."""
    named = raw.select(*[F.col(c).alias(DEPARTMENT_NAMES.get(c, c)) for c in raw.columns])
    return leading_digit_codes(named, "SectionCD", "LCD")


def levels(dept: DataFrame) -> tuple[DataFrame, Climb]:
    """One row per section with its ancestors placed in level columns, and the climb."""
    climbed = climb(dept, "SectionCD", "ParentSectionCD", ["LCD"])
    names = keep_first(
        dept.select(F.col("SectionCD").alias("code"), F.col("SectionNameEN").alias("name_en"),
                    F.col("name_localized").alias("name_jp")),
        "code", ["name_en", "name_jp"])
    chain = climbed.chain.select("leaf", "depth", F.col("SectionCD").alias("code"), F.col("LCD").alias("level"))
    return level_columns(chain, names), climbed


def unplaced(dept: DataFrame) -> DataFrame:
    """The sections that a cycle keeps out of the tree, for the report table."""
    cyclic = climb(dept, "SectionCD", "ParentSectionCD").cyclic
    return dept.join(cyclic, F.col("SectionCD") == F.col("leaf"), "left_semi")


def hr_master(person: DataFrame, email: DataFrame, job: DataFrame, dept: DataFrame) -> DataFrame:
    """One row per person with an active job in a current department.

    ``dept`` is the output of :func:`departments`. Of several jobs or e-mails of a
    person the first by (e-mail, job, section) columns is kept. A section without a
    place in the tree leaves its people with blank levels.
    """
    # Written once each: read several times below, and then of known size to Spark.
    dept = materialise(dept, "departments")
    placed = materialise(levels(dept)[0], "levels")
    section = dept.drop("ParentSectionCD", "cust_string17", "SectionNameJP")
    people = full_outer(person.drop("startDate", "endDate", "challengeStatus"), email, "personIdExternal")
    joined = (
        people.join(job, F.col("personIdExternal") == F.col("userId"), "inner")
        .join(section, F.col("department") == F.col("SectionCD"), "inner")
    )
    ties = ["emailAddress", "department", "jobCode", "managerId"]
    first = keep_first(joined, "personIdExternal", ties)
    master = first.join(placed, F.col("SectionCD") == F.col("identifier"), "left")
    levelled = [c for c in placed.columns if c != "identifier"]
    named = master.select(*[F.col(c).alias(n) for c, n in MASTER_NAMES.items()], *levelled)
    cleaned = blank_matching(named, [f"L{n}NameJP" for n in CLEANED_LEVELS], LEVEL_LABEL)
    return cleaned.na.fill(EMPTY)
