"""File systems that tasks open by themselves."""

import io

from pyarrow import fs

# Names that Spark's storage has for the same schemes.
_SAME = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss", "wasb": "abfs"}
SCHEMES = ("file", "s3", "s3a", "s3n", "gs", "gcs", "hdfs", "viewfs", "abfs", "abfss", "wasb", "wasbs")


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    return fs.FileSystem.from_uri(known_uri(uri))


def known_uri(uri: str) -> str:
    """A URI as the file systems spell it. Schemes are those of ``SCHEMES``; another one is refused by name."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")  # as Hadoop writes local paths
    scheme, colon, rest = uri.partition(":/")
    if colon and "/" not in scheme:
        if scheme not in SCHEMES:
            raise ValueError(f"tasks cannot open {scheme}: paths; they can open {', '.join(SCHEMES)}")
        uri = f"{_SAME.get(scheme, scheme)}:/{rest}"
    return uri


class _Stored(io.RawIOBase):
    """A stored file for readers that expect what files of the operating system do."""

    def __init__(self, source) -> None:
        self.source, self.size = source, source.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.source.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.source.tell(), io.SEEK_END: self.size}[whence]
        if place < 0:
            raise OSError("a place before the file begins")
        self.source.seek(place)
        return place

    def readinto(self, buffer) -> int:
        return self.source.readinto(buffer)

    def close(self) -> None:
        self.source.close()
        super().close()


def open_stored(uri: str) -> io.BufferedReader:
    """A file of any known storage, to be read at any place."""
    storage, path = filesystem(uri)
    return io.BufferedReader(_Stored(storage.open_input_file(path)), 1 << 18)
