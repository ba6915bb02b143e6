"""An injected transport for tests."""

PAGES = {
    "mem://a/1": "<table><tr><th>no</th><th>title</th><th>date</th><th>file</th></tr><tr><td>3</td><td>Third <b>post</b></td><td>2026-03-04</td><td>y</td></tr><tr><td>2</td><td>Second</td><td>2026.02.01</td><td></td></tr></table>",
    "mem://a/2": "<table><tr><td>2</td><td>Second again</td><td>2026.02.01</td><td>y</td></tr><tr><td>1</td><td>First</td><td>26/01/05</td><td>y</td></tr></table>",
    "mem://b/1": '[{"no": 9, "title": "json", "date": null, "file": "y"}]',
}


def get(url: str) -> bytes:
    return PAGES[url].encode()


#: Requests so far, and a session that ends once.
SEEN: list[str] = []
PAGES["mem://c/1"] = "<p>전체게시글 : 3 / 전체페이지 : 2</p><ul><li><span class='blind'>no</span><span><label class='blind'>title</label> Third <b>one</b></span><div>dept<div>x</div></div><span>2026.01.02</span></li><li><span>2</span></li></ul>"
PAGES["mem://c/2"] = "<ul><li><span>1</span><a href='/download?f=1'>a.xlsx</a></li></ul>"
PAGES["mem://s/enter"] = '<meta name="_csrf" content="t1">'


def ended_once(url: str) -> bytes:
    SEEN.append(url)
    if url.startswith("mem://s/list"):
        return b"<html>log in</html>" if SEEN.count(url) == 1 else b'[{"no": 1, "title": "in"}]'
    return get(url)


def from_folder(path: str) -> bytes:
    """Pages that are files; each request is noted beside them."""
    import pathlib

    file = pathlib.Path(path)
    with open(file.parent / "seen", "a") as seen:
        seen.write(f"{file.name}\n")
    return file.read_bytes()
