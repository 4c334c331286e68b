import contextlib
import io


def plan_text(df, mode: str = "formatted") -> str:
    """The text ``DataFrame.explain`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan_operators(df) -> set[str]:
    """Names of the physical operators in the plan tree."""
    import re

    text = plan_text(df, "simple")
    return set(re.findall(r"^[\s+:\-*()0-9]*([A-Z][A-Za-z]+)", text, flags=re.M))
