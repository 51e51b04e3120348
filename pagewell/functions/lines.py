"""A row parser for plain text: one document per line that is not blank."""


def line_documents(content: str, source: str) -> list[dict]:
    return [
        {"title": f"{source} {number}", "content": line, "metadata": {"line": number}}
        for number, line in enumerate(content.split("\n")) if line.strip()]
