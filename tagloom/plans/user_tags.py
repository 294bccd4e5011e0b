"""Tags of the user table: one row per user, a projection each."""

from __future__ import annotations

from tagloom import labels as L
from tagloom.functions.ladders import bin_ladder, decode
from tagloom.functions.timing import birth_year, days_since, month_day
from tagloom.plans.tag import Tag


def num() -> Tag:
    return Tag({"num": "CAST(id AS STRING)"})


def gender(book=L.GENDER) -> Tag:
    return Tag({"gender": decode("gender", book, L.UNKNOWN)})


def job(book=L.JOB) -> Tag:
    return Tag({"job": decode("job", book, L.JOB_DEFAULT)})


def marriage(book=L.MARRIAGE) -> Tag:
    return Tag({"marriage": decode("marriage", book, L.UNKNOWN)})


def nationality(book=L.NATIONALITY) -> Tag:
    return Tag({"nationality": decode("nationality", book, L.UNKNOWN)})


def political_face(book=L.POLITICAL_FACE) -> Tag:
    return Tag({"politicalFace": decode("politicalFace", book, L.UNKNOWN)})


def age_range(ladder=L.AGE_RANGE) -> Tag:
    return Tag({"ageRange": bin_ladder("birth_year", ladder, L.UNKNOWN)}, values={"birth_year": birth_year("birthday")})


def constellation(ladder=L.CONSTELLATION) -> Tag:
    return Tag({"constellation": bin_ladder("birth_day", ladder, L.UNKNOWN)}, values={"birth_day": month_day("birthday")})


def latest_login(as_of: str, ladder=L.LATEST_LOGIN) -> Tag:
    """Days from the last login back from ``as_of``; later logins stay in the default."""
    return Tag({"LatestLogin": bin_ladder("login_days", ladder, L.LATEST_LOGIN_DEFAULT)},
               values={"login_days": days_since(as_of, "lastLoginTime")})


def user_tags(as_of: str) -> dict[str, Tag]:
    return {
        "num": num(),
        "gender": gender(),
        "job": job(),
        "marriage": marriage(),
        "nationality": nationality(),
        "political_face": political_face(),
        "age_range": age_range(),
        "constellation": constellation(),
        "latest_login": latest_login(as_of),
    }
