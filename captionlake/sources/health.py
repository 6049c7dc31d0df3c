"""Checks before a run: where requests may go, which models answer, whether the table's folder can be used."""

from __future__ import annotations

import ipaddress
import socket
from collections.abc import Callable, Iterable
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

#: Fixed value: shared address space that counts as internal too.
SHARED_NETWORK = ipaddress.ip_network("100.64.0.0/10")


def url_allowed(url: str, allow_insecure: bool = False, resolve: Callable[[str], str] = socket.gethostbyname) -> bool:
    """HTTPS goes anywhere; HTTP only to this machine and to private or shared addresses, unless ``allow_insecure``."""
    parts = urlsplit(url or "")
    if parts.scheme == "https":
        return True
    if parts.scheme != "http" or not parts.hostname:
        return False
    if allow_insecure or parts.hostname in ("localhost", "127.0.0.1", "::1"):
        return True
    try:
        address = ipaddress.ip_address(resolve(parts.hostname))
    except (OSError, ValueError):
        return False
    return address.is_private or (address.version == 4 and address in SHARED_NETWORK)


def model_listed(list_models: Callable[[], Iterable[str]], model: str) -> tuple[bool, str]:
    """Whether the caller's client lists a model; a failed call is told, not raised."""
    try:
        names = set(list_models())
    except Exception as e:  # noqa: BLE001
        return False, f"models cannot be listed: {str(e)[:200]}"
    return (True, "ok") if model in names else (False, f"{model} is not among {len(names)} models")


def folder_usable(spark: SparkSession, path: str) -> tuple[bool, str]:
    """Whether a folder exists or can be made, in any store that Spark reaches."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if fs.exists(target):
            return (True, "ok") if fs.getFileStatus(target).isDirectory() else (False, f"{path} is a file")
        return (True, "made") if fs.mkdirs(target) else (False, f"{path} cannot be made")
    except Exception as e:  # noqa: BLE001
        return False, f"{path}: {str(e)[:200]}"
