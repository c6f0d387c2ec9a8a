"""Replacing placeholders in option values."""

import pytest

from sluiceway.functions import UnresolvedPlaceholder, resolve_options


@pytest.fixture(autouse=True)
def variables(monkeypatch):
    monkeypatch.setenv("SET_A", "value a")
    monkeypatch.setenv("SET_B", "value b")
    monkeypatch.delenv("UNSET", raising=False)


def one(value, **how):
    return resolve_options({"key": value}, **how)["key"]


@pytest.mark.parametrize(
    ("value", "result"),
    [
        ("plain", "plain"),
        ("${env:SET_A}", "value a"),
        ("${env:UNSET}", "${env:UNSET}"),
        ("x${env:SET_A}y", "value a"),
        ("${env:SET_A}-${env:SET_B}", "${env:SET_A}-${env:SET_B}"),
        ("${file:/no/such/file}", "${file:/no/such/file}"),
        ("${other:SET_A}", "${other:SET_A}"),
        ("", ""),
    ],
)
def test_values(value, result):
    assert one(value) == result


def test_file(tmp_path):
    file = tmp_path / "query.sql"
    file.write_text("SELECT 'é'\nFROM t", encoding="utf-8")
    assert one(f"${{file:{file}}}") == "SELECT 'é'\nFROM t"
    assert one(f"before ${{file:{file}}} after") == "SELECT 'é'\nFROM t"


def test_unset_variable_is_not_tried_as_a_file(tmp_path):
    file = tmp_path / "f"
    file.write_text("content")
    value = f"${{env:UNSET}} ${{file:{file}}}"
    assert one(value) == value


@pytest.mark.parametrize(
    "value", ["${env:UNSET}", "x${env:SET_A}", "${file:/no/such/file}", "${env:SET_A}-${env:SET_B}"]
)
def test_strict(value):
    with pytest.raises(UnresolvedPlaceholder, match="key") as error:
        one(value, strict=True)
    assert "value a" not in str(error.value)


def test_strict_accepts_whole_placeholders():
    assert one("${env:SET_A}", strict=True) == "value a"
    assert one("plain", strict=True) == "plain"
