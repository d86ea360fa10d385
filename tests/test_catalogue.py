import pytest

from lading.sources.catalogue import active_providers, read_catalogue

TOML = """
[[providers]]
name = "a"
is_active = true
static_url = "https://x/"
static_provider = "a?c=1"
database_id = "id-a"

[[providers]]
name = "b"
static_url = "https://x/"
static_provider = "b"
database_id = "id-b"

[[providers]]
name = "c"
is_active = true
static_url = "https://x/"
static_provider = "c"
database_id = ""
"""


def test_catalogue(spark, tmp_path):
    p = tmp_path / "providers.toml"
    p.write_text(TOML)
    cat = read_catalogue(spark, str(p))
    assert {r["name"]: r["is_active"] for r in cat.collect()} == {"a": True, "b": False, "c": True}
    assert [(r["provider"], r["url"]) for r in active_providers(cat).collect()] == [("a", "https://x/a?c=1")]


def test_missing_database_id_fails(spark, tmp_path):
    p = tmp_path / "providers.toml"
    p.write_text('[[providers]]\nname = "a"\nstatic_url = "u"\nstatic_provider = "p"\n')
    with pytest.raises(ValueError):
        read_catalogue(spark, str(p))
