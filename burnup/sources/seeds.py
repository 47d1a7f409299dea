"""Seed rows inserted when absent (S8, S9, S10) via the generic insert-if-absent."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from burnup.operators.apply import insert_if_absent

# The entity registry seed (name, service id, schedule, field map, load order).
ENTITY_SCHEDULE = "0 12 ? * SUN *"
ENTITY_SEED = [
    ("Portfolio", 114, ENTITY_SCHEDULE, '{"id": 11401, "title": 11402}', 1),
    ("Project", 4, ENTITY_SCHEDULE,
     '{"id": 435,"ahaid": 2473870467,"title": 436,"status": 411,"category": 400027,"startdate": 428,'
     '"targetdate": 430,"canbetemplate": 402,"completiondate": 403,"associatedportfolio": 2476747173}', 2),
    ("Resources", 11, ENTITY_SCHEDULE,
     '{"id": 101127,"type": 1126,"unitid": 101113,"emailId": 1115,"type_id": 1112,"lastName": 1104,'
     '"firstName": 1103,"full_name": 1136,"hire_date": 1101,"primaryroleID": 1110,"termination_date": 1102}', 5),
    ("Unit", 229, ENTITY_SCHEDULE, '{"id": 22905, "title": 22901, "managerId": 22902, "parentTitle": 22904}', 4),
    ("Task", 5, ENTITY_SCHEDULE,
     '{"id": 522,"Title": 529,"projectId": 528,"startdate": 518,"targetdate": 520,"TimeReportable": 2490397259,'
     '"completiondate": 502,"investmentType": 2471647575, "isRnD": 2471629734, "isCapitalized": 563, '
     '"taskType": 513}', 3),
    ("Events", 192, ENTITY_SCHEDULE,
     '{"id": 19201,"title": 19202,"toDate": 19207,"typeId": 19204,"fromDate": 19206,"calendarId": 19203,'
     '"workingTime": 19217,"timesheetEntryType": 19209}', 6),
    ("rate_table", 280, ENTITY_SCHEDULE,
     '{"active": 28004,"isDefault": 28006,"description": 28003,"id": 28001,"retired": 28005,"title": 28002}', 7),
    ("rate_user_map", 283, ENTITY_SCHEDULE, '{"id": 28300,"rateId": 28301,"humanResourceId": 28302,"effectiveDate": 28303}', 8),
    ("rate_details", 281, ENTITY_SCHEDULE,
     '{"rateId": 28105,"capExRate": 28103,"effectiveDate": 28104,"id": 28101,"opExRate": 28102}', 9),
]
ENTITY_SCHEMA = ("entity_name string, entity_ppm_id int, load_frequency string, column_select_list string, "
                 "load_sequence int")

# Administrative (leave) task types and their service ids.
ADMIN_TASK_SEED = [
    ("Holiday", 7), ("Jury Duty", 5), ("PTO", 4), ("Bereavement", 3), ("Floating Holiday", 2),
    ("Workers Comp", 103), ("Short-term Disability", 102), ("Maternity/Paternity Leave", 101),
    ("Leave without Pay", 100),
]
ADMIN_TASK_SCHEMA = "admin_task_name string, admin_task_ppm_id int"

# Holidays seeded into the calendar.
HOLIDAY_SEED = [
    (dt.datetime(2019, 12, 24), "Day Before Christmas Holiday", "US", "US", True),
    (dt.datetime(2019, 12, 25), "Christmas", "US", "US", True),
    (dt.datetime(2019, 12, 31), "New Years Eve", "US", "US", True),
    (dt.datetime(2020, 1, 1), "New Years Day", "US", "US", True),
]
HOLIDAY_SCHEMA = ("holiday_date timestamp_ntz, holiday_name string, holiday_country string, holiday_state string, "
                  "is_mandatory_holiday boolean")


def seed_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def seed_entities(spark: SparkSession, registry: DataFrame) -> DataFrame:
    """Registry rows for the nine entities, added where the service id is absent."""
    return insert_if_absent(registry, seed_frame(spark, ENTITY_SEED, ENTITY_SCHEMA), "entity_ppm_id")


def seed_admin_tasks(spark: SparkSession, tasks: DataFrame) -> DataFrame:
    """S9"""
    return insert_if_absent(tasks, seed_frame(spark, ADMIN_TASK_SEED, ADMIN_TASK_SCHEMA), "admin_task_ppm_id")


def seed_holidays(spark: SparkSession, holidays: DataFrame) -> DataFrame:
    """S10"""
    return insert_if_absent(holidays, seed_frame(spark, HOLIDAY_SEED, HOLIDAY_SCHEMA), "holiday_date")
