"""The entry module without the optional part, and with a library missing that the optional part needs."""

import subprocess
import sys
import textwrap

from conftest import ROOT


def names(blocked: str) -> list[str]:
    """Query names and the reasons noted, in a fresh process in which ``blocked`` cannot be imported."""
    code = f"""
        import sys

        class Blocked:
            def find_spec(self, name, *_):
                if name.split(".")[0] == {blocked!r} or name == {blocked!r}:
                    raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

        sys.meta_path.insert(0, Blocked())
        import __spark_entry__ as e
        assert set(e.oracle_sql()) <= set(e.queries())
        print("\\n".join([*e.queries(), *("!" + m for m in e.LLM_MISSING)]))
    """
    out = subprocess.run([sys.executable, "-B", "-c", textwrap.dedent(code)], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    return out.stdout.split("\n")


def test_the_other_queries_stay_when_a_library_is_missing():
    for blocked in ("xxhash", "strata.llm", "corpus_pipeline"):
        found = names(blocked)
        assert sum(n.startswith("q_") for n in found) >= 44
        assert any(n.startswith("!") and blocked in n for n in found), found
    assert not any(n.startswith("op") for n in names("strata.llm"))
    assert any(n.startswith("op1_") for n in names("corpus_pipeline"))
