"""Credentials and connector options from the environment.

Nothing secret is written in code: user and password come from environment
variables and are placed into the connection URI only when options are built.
"""

from __future__ import annotations

import os
from urllib.parse import quote_plus

# The environment variable names holding the document-store login.
USER_VAR = "MONGO_INITDB_ROOT_USERNAME"
PASSWORD_VAR = "MONGO_INITDB_ROOT_PASSWORD"


def document_store_uri(host: str, database: str, collection: str,
                       auth_source: str = "admin", env: dict[str, str] | None = None) -> str:
    """``mongodb://user:pass@host/db.collection?authSource=...`` from the environment."""
    env = os.environ if env is None else env
    user, password = env.get(USER_VAR), env.get(PASSWORD_VAR)
    login = f"{quote_plus(user)}:{quote_plus(password)}@" if user and password else ""
    return f"mongodb://{login}{host}/{database}.{collection}?authSource={auth_source}"


def document_store_options(host: str, database: str, collection: str,
                           env: dict[str, str] | None = None) -> dict[str, str]:
    """Reader/writer options naming one collection (for S10, K4, K5)."""
    uri = document_store_uri(host, database, collection, env=env)
    return {"connection.uri": uri, "database": database, "collection": collection}


def redacted(options: dict[str, str]) -> dict[str, str]:
    """Options safe to log: the password part of any URI is masked."""
    out = {}
    for key, value in options.items():
        if "://" in value and "@" in value:
            scheme, rest = value.split("://", 1)
            creds, tail = rest.split("@", 1)
            user = creds.split(":", 1)[0]
            value = f"{scheme}://{user}:***@{tail}"
        out[key] = value
    return out
