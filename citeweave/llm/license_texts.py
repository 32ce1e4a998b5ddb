"""Notices and phrases of public licences: label, text, and the key phrase that must stand in it."""

#: The licences' own published wording.
LICENCES = (
    ("gpl", "licensed under the GNU General Public License", "General Public License"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "GNU General Public License",
    ),
    ("lgpl", "GNU Lesser General Public License", "Lesser General Public License"),
    ("agpl", "GNU Affero General Public License", "Affero General Public License"),
    ("apache-2.0", "licensed under the Apache License, Version", "Apache License"),
    (
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
        "Apache License",
    ),
    ("mit", "released under the MIT License", "MIT License"),
    ("mit", "licensed under the MIT License", "MIT License"),
    ("mit", "Permission is hereby granted, free of charge", "hereby granted free of charge"),
    (
        "mit",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
        "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Permission is hereby granted",
    ),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "with or without fee is hereby granted"),
    ("bsd", "Redistribution and use in source and binary forms", "source and binary forms"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistribution and use in source and binary forms",
    ),
    ("mpl", "subject to the terms of the Mozilla Public License", "Mozilla Public License"),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Mozilla Public License",
    ),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.", "without any express or implied warranty"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0", "Boost Software License"),
    ("epl", "made available under the terms of the Eclipse Public License", "Eclipse Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    ("cc-by", "licensed under CC BY", "CC BY"),
    ("cc-by-nc", "licensed under CC BY NC", "CC BY NC"),
    ("cc-by-sa", "licensed under CC BY SA", "CC BY SA"),
    ("cc-by-nd", "licensed under CC BY ND", "CC BY ND"),
    ("cc-by", "Creative Commons Attribution", "Creative Commons Attribution"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", "Creative Commons Attribution"),
    ("cc0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to the public domain worldwide", "dedicated all copyright and related and neighboring rights"),
    ("public-domain", "dedicated to the public domain", "public domain"),
    ("reserved", "Copyright All rights reserved", "All rights reserved"),
    ("reserved", "All rights reserved", "All rights reserved"),
)
