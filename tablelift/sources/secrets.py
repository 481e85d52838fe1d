"""The password of a connection: a file decrypted by a key service, a plain file, or the option itself."""

from __future__ import annotations

import base64
import json
import os
import re
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

#: Fixed value: the public address of the key service.
SERVICE = "https://cloudkms.googleapis.com/v1/"


def _post(url: str, body: dict) -> dict:
    """Default transport, with the access token of the environment."""
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get('KMS_ACCESS_TOKEN', '')}"})
    with urllib.request.urlopen(request) as answer:
        return json.load(answer)


def _setting(name: str, default: str | None = None):
    return field(default_factory=lambda: os.environ.get(name, default))


@dataclass(frozen=True)
class KmsDecrypter:
    """Key names come from the environment; `post` sends a JSON body and returns the JSON answer."""

    project: str | None = _setting("KMS_PROJECT")
    location: str = _setting("KMS_LOCATION", "global")
    keyring: str = _setting("KMS_KEYRING", "tablelift")
    key: str = _setting("KMS_KEY", "default")
    post: Callable[[str, dict], dict] = _post

    def decrypt(self, ciphertext: str) -> str:
        """The plain text of a base64 cipher text, in which white space does not count."""
        if not self.project:
            raise ValueError("KMS_PROJECT must be set to decrypt a password")
        name = f"projects/{self.project}/locations/{self.location}/keyRings/{self.keyring}/cryptoKeys/{self.key}"
        answer = self.post(f"{SERVICE}{name}:decrypt", {"ciphertext": re.sub(r"\s", "", ciphertext)})
        return base64.b64decode(answer["plaintext"]).decode()


def read_password(read: Callable[[str], str], encrypted_file: str | None, file: str | None, password: str | None, decrypter: KmsDecrypter | None = None) -> str | None:
    """First of: the encrypted file (stripped once decrypted), the plain file (as it is), the password."""
    if encrypted_file is not None:
        return (decrypter or KmsDecrypter()).decrypt(read(encrypted_file)).strip()
    return read(file) if file is not None else password
