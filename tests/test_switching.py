"""A run is published whole or not at all."""

import pytest

from stallbook.plans import switching
from stallbook.plans.switching import Folder, publish, recover, require_apart

NAMES = ("a.csv", "b.csv", "meta.json")


def writers(text, fails=None):
    def writer(name):
        def write(into):
            if name == fails:
                raise OSError(f"no {name}")
            with open(f"{into}/{name}", "w") as file:
                file.write(text)

        return write

    return {name: writer(name) for name in NAMES}


def found(path):
    return {file.name: file.read_text() for file in path.iterdir() if not file.name.startswith(".")}


@pytest.fixture
def old(spark, tmp_path):
    (tmp_path / "own.txt").write_text("mine")
    folder = Folder(spark, str(tmp_path))
    publish(folder, writers("old"), "meta.json", 2)
    return folder


KEPT = {**dict.fromkeys(NAMES, "old"), "own.txt": "mine"}


def test_a_new_run_replaces_the_old_one_and_nothing_else(old, tmp_path):
    assert found(tmp_path) == KEPT
    publish(old, writers("new"), "meta.json", 2)
    assert found(tmp_path) == {**dict.fromkeys(NAMES, "new"), "own.txt": "mine"}


@pytest.mark.parametrize("name", NAMES)
def test_a_failure_while_writing_leaves_the_old_run(old, tmp_path, name):
    with pytest.raises(OSError, match=f"no {name}"):
        publish(old, writers("new", fails=name), "meta.json", 2)
    assert found(tmp_path) == KEPT


@pytest.mark.parametrize("moves", range(6))
def test_a_failure_while_switching_leaves_the_old_run(old, tmp_path, monkeypatch, moves):
    real, done = Folder.move, []

    def move(self, *names):
        if len(done) == moves:
            done.append("failed")
            raise OSError("no move")
        done.append(names)
        real(self, *names)

    monkeypatch.setattr(Folder, "move", move)
    with pytest.raises(OSError, match="no move"):
        publish(old, writers("new"), "meta.json", 2)
    assert found(tmp_path) == KEPT


@pytest.mark.parametrize("moves", range(7))
def test_the_next_run_puts_back_what_a_lost_driver_left(old, tmp_path, monkeypatch, moves):
    real, done = Folder.move, []

    class Lost(BaseException):
        pass

    def move(self, *names):
        if len(done) == moves:
            raise Lost
        done.append(names)
        real(self, *names)

    def nothing(*_):
        raise Lost

    with monkeypatch.context() as patched:
        patched.setattr(Folder, "move", move)
        patched.setattr(Folder, "delete", nothing)
        patched.setattr(switching, "_put_back", nothing)
        with pytest.raises(Lost):
            publish(old, writers("new"), "meta.json", 2)
    # Metadata is there only with a whole run, the new one after all six moves.
    left = {name: text for name, text in found_files(tmp_path).items() if name in NAMES}
    if "meta.json" in left:
        assert set(left.values()) == {"new" if moves == 6 else "old"} and len(left) == 3
    recover(old, "meta.json")
    assert found(tmp_path) == ({**dict.fromkeys(NAMES, "new"), "own.txt": "mine"} if moves == 6 else KEPT)


def found_files(path):
    return {file.name: file.read_text() for file in path.iterdir() if file.is_file() and not file.name.startswith(".")}


@pytest.mark.parametrize(
    "source, apart",
    [
        ("in.csv", True),
        ("out/a.csv", False),
        ("out/a.csv/part-0.csv", False),
        ("out/./x/../a.csv", False),
        ("out", False),
        (".", False),
        ("out/*", False),
        ("out/b.csv/part-*", False),
        ("out/a.csv.old", True),
        ("other/*.csv", True),
    ],
)
def test_sources_that_an_output_would_replace(spark, tmp_path, source, apart):
    folder = Folder(spark, f"{tmp_path}/out")
    if apart:
        require_apart(folder, f"{tmp_path}/{source}", list(NAMES))
    else:
        with pytest.raises(ValueError, match="would replace the input"):
            require_apart(folder, f"file://{tmp_path}/{source}", list(NAMES))
