"""Notices and key passages of public licenses, by SPDX identifier (a number after # tells passages apart)."""

TEMPLATES = {
    "MIT#1": "Released under the MIT License.",
    "MIT#2": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "Apache-2.0#1": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0#2": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "GPL-3.0#1": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0#2": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "GPL-2.0#1": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version."
    ),
    "LGPL-2.1#1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version."
    ),
    "BSD#1": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "BSD-3-Clause#1": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission."
    ),
    "ISC#1": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0#1": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense#1": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0#1": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0#1": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0#1": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0#2": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
}
