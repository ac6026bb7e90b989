import pytest

from loomspark.settings import Settings, env_int


@pytest.mark.parametrize("raw,want", [(None, 8), ("", 8), ("12", 12), ("3.9", 3), ("-1", 8), ("0", 8), ("x", 8), ("inf", 8), ("nan", 8)])
def test_env_int(raw, want):
    assert env_int({} if raw is None else {"N": raw}, "N", 8) == want


def test_settings():
    s = Settings.read("/app", {"PLAYWRIGHT_DISABLED_HOSTS": " www.Slow.example, ,x.example", "STAGE_FALLBACK_BUDGET_MS": "5"})
    assert (s.output, s.rendered, s.rendered_off_hosts, s.fallback_budget_ms, s.discovery_budget_ms) == ("/app/output", True, ("slow.example", "x.example"), 5, 90_000)
    assert Settings.read("/app", {"APP_ROOT": " /srv ", "PLAYWRIGHT_ENABLED": "false"}) == Settings("/srv", "/srv/output", 8, 90_000, 35_000, False, ())
